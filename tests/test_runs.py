import json
import subprocess
import sys
from pathlib import Path

import pytest

from kinfold import cli
from kinfold.operators.cells import flatten
from kinfold.options import Options, SourceOptions
from kinfold.plans.engine import cluster_files, cluster_records, run
from kinfold.plans.session import session
from kinfold.sources.readers import read_records, read_truth
from kinfold.sources.writers import write_clusters, write_text_file
from kinfold.streaming import keyed_stream, running_block_sizes

PEOPLE = """id,fname,lname,city
X1,MARIN,TESTER,SAMPLETON
X2,MARIIN,TESTER,sampleton
X3,Quentin,Zumwalt,Elsewhere
X4,Quentin,Zumwalt,Elsewhere
"""


@pytest.fixture()
def people(tmp_path):
    (tmp_path / "people.csv").write_text(PEOPLE.replace("\n", "\r"))
    (tmp_path / "truth.csv").write_text("refID,truthID\nX1,a\nX2,a\nX3,b\nX4,b\n")
    return tmp_path


def test_formats(spark, people):
    csv = read_records(spark, str(people / "people.csv"), SourceOptions("csv", True, key_columns=("id",)))
    assert csv.count() == 4 and csv.schema["record_id"].dataType.simpleString() == "bigint"
    (people / "t.tsv").write_text("a\t\tc\nd\te\n")
    assert sorted(r.value for r in flatten(read_records(spark, str(people / "t.tsv"), SourceOptions("tsv"))).collect()) == ["a", "c", "d", "e"]
    (people / "t.txt").write_text("alpha|b2;gamma\tdelta\n\n")
    cells = flatten(read_records(spark, str(people / "t.txt"), SourceOptions("text"))).collect()
    assert [(r.col_index, r.value) for r in cells] == [(0, "alpha"), (1, "b2"), (2, "gamma"), (3, "delta")]
    assert [r.value for r in flatten(read_records(spark, str(people / "t.txt"), SourceOptions("text", text_split_regex=""))).collect()] == ["alpha|b2;gamma\tdelta"]
    csv.select("fname", "lname").write.parquet(str(people / "p.parquet"))
    one, two = (read_records(spark, str(people / "p.parquet"), SourceOptions("parquet")).select("record_id", "fname").collect() for _ in range(2))
    assert sorted(one) == sorted(two) and len({r.record_id for r in one}) == 4
    with pytest.raises(ValueError):
        SourceOptions("json")


def test_run(spark, people):
    options = Options().with_overrides(input_has_header=True, skip_leading_columns=1, clustering_method="arcs", arcs_tau=0.6, truth_file=str(people / "truth.csv"), emit_length_key=False, emit_token_key=False)
    report = run(str(people / "people.csv"), str(people / "out"), options, spark)
    assert report["pair_metrics"]["E"] == 2 and report["pair_metrics"]["recall"] > 0
    assert json.loads((people / "out/_metrics/metrics.json").read_text())["predicted_clusters"]["n_total"] == report["predicted_clusters"]["n_total"]
    assert "== pair metrics" in (people / "out/_metrics/metrics.log").read_text()
    assert spark.read.parquet(str(people / "out")).count() == report["predicted_clusters"]["n_total"]


def test_run_density_json(spark, people):
    options = Options().with_overrides(input_has_header=True, input_format="csv", key_columns=("id",), output_format="json", metrics_enabled=False, dbscan_eps=0.1, vertices="blocked")
    assert "members" in cluster_files(str(people / "people.csv"), str(people / "out"), spark, options).columns


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError):
        write_clusters(spark.range(1), str(tmp_path / "x"), "csv")
    for text in ("one", "twö"):
        write_text_file(spark, str(tmp_path / "d/f.txt"), text)
        assert (tmp_path / "d/f.txt").read_text() == text


def test_truth(spark, people):
    assert sorted(map(tuple, read_truth(spark, str(people / "truth.csv")).collect()))[0] == ("X1", "a")


def test_empty_records(spark):
    empty = spark.createDataFrame([], "record_id long, source string, a string")
    for method in ("arcs", "dbscan"):
        assert cluster_records(empty, Options().with_overrides(clustering_method=method)).count() == 0


def test_command_line():
    arguments = cli.parser().parse_args("--input a --output b --format tsv --has-header --clustering-method arcs --arcs-tau 0.4 --no-metrics --cohesion 0.2 --no-emit-token-key --length-bucket-edges 1 5 9 --eps 0.1 --min-samples 4 --arcs-no-merge --arcs-do-purge".split())
    options = cli.options_of(arguments)
    assert (options.source.input_format, options.source.input_has_header, options.redundancy.arcs_tau) == ("tsv", True, 0.4)
    assert (options.density.dbscan_eps, options.density.dbscan_min_samples, options.redundancy.arcs_do_merge, options.redundancy.arcs_do_purge) == (0.1, 4, False, True)
    assert not options.run.metrics_enabled and not options.keys.emit_token_key and options.keys.length_bucket_edges == (1, 5, 9)
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["--input", "a"])


def test_session_is_the_callers(spark):
    with session(spark) as own:
        assert own is spark


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("1,alpha\n2,alpine\n3,beta\n")
    stream = spark.readStream.schema("id long, name string").csv(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        keyed_stream(stream, ())
    query = running_block_sizes(stream, ("id",)).writeStream.outputMode("complete").format("memory").queryName("sizes").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.block_key: r["size"] for r in spark.table("sizes").collect()}["PFX_alp"] == 2


def test_entry_without_the_subpackage():
    root = Path(__file__).resolve().parents[1]
    code = "import sys\nsys.modules['kinfold.llm'] = None\nsys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\nassert 'cells_flatten' in e.queries() and not any(k.startswith('op') for k in e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[1]
    for path in (root / "kinfold").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "kinfold.llm" not in path.read_text()
