import gzip
import json

import pytest
from pyspark.sql import functions as F

from gristmill.sources import config, inference, readers, sinks
from gristmill.streaming import ingest, stages


@pytest.fixture
def drop(tmp_path):
    d = tmp_path / "ds" / "v1.2"
    d.mkdir(parents=True)
    (d / "train.jsonl").write_text("".join(json.dumps({"user": f"q{i}", "assistant": f"a{i}"}) + "\n" if i != 2 else "\n" for i in range(6)) + "oops\n[1]\n")
    with gzip.open(d / "test.jsonl.gz", "wt") as f:
        f.write('{"user": "g", "assistant": "h"}\n')
    (tmp_path / "ds" / ".cache").mkdir()
    (tmp_path / "ds" / ".cache" / "x.jsonl").write_text("{}\n")
    (tmp_path / "ds" / "README.md").write_text("---\nlicense: mit\n---\nText\n")
    return str(tmp_path / "ds")


def test_policies_and_recipes(spark, tmp_path, monkeypatch):
    source = lambda **more: {"id": "a", "repo": "x/a", "local_dir": "a", "category": "math", "role": "train_candidate"} | more

    def load(*sources, version=1):
        (tmp_path / "p.json").write_text(json.dumps({"schema_version": version, "sources": list(sources)}))
        return config.load_policies(tmp_path / "p.json")

    assert load(source(), source(id="b", repo="x/b", recommended_max_weight=0.5))[1]["max_weight"] == 0.5
    for bad, why in (((source(), source()), "unique"), ((source(), source(id="b")), "unique"), ((source(role=" "),), "missing"), ((source(recommended_max_weight=True),), "numeric"), ((source(audit_mode="x"),), "audit_mode"), ((source(stats_sample_rows=-1),), "non-negative"), ((), "non-empty")):
        with pytest.raises(ValueError, match=why):
            load(*bad)
    with pytest.raises(ValueError, match="schema_version"):
        load(source(), version=2)
    assert config.policy_table(spark, load(source())).first()["recommended_tier"] == "QUARANTINE"
    (tmp_path / "i-one.json").write_text(json.dumps({"sampling_mass": {"math": 0.4, "code": 0.6}, "buckets": {"math": {"candidates": ["a", "b"]}}}))
    (tmp_path / "other.json").write_text("{}")
    recipes = config.load_recipes(tmp_path)
    assert list(recipes) == ["i-one"]
    assert sorted(tuple(r) for r in config.recipe_rows(spark, recipes).collect()) == [("i-one", "math", "a", 0.4), ("i-one", "math", "b", 0.4)]
    monkeypatch.delenv(config.ROOT_VARIABLE, raising=False)
    assert config.resolve_root(tmp_path) is None
    (tmp_path / "data").mkdir()
    (tmp_path / "env").mkdir()
    assert config.resolve_root(tmp_path) == tmp_path / "data" and config.resolve_root(tmp_path, str(tmp_path / "no"), str(tmp_path / "env")) == tmp_path / "env"
    monkeypatch.setenv(config.ROOT_VARIABLE, str(tmp_path / "env"))
    assert config.resolve_root(tmp_path) == tmp_path / "env"


def test_audit_and_token_readers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "source_dataset string, n long")
    sinks.write_audit(df, str(tmp_path / "audit"))
    assert {r["n"] for r in readers.read_audit(spark, str(tmp_path / "audit"), ["b"]).collect()} == {2} and readers.read_audit(spark, str(tmp_path / "audit")).count() == 2
    (tmp_path / "t.jsonl").write_text('{"n": 1}\n{"n": 2}\n')
    assert readers.read_tokens(spark, str(tmp_path / "t.jsonl")).count() == 2
    (tmp_path / "t.jsonl").write_text('{"n": 1}\n{"n": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_tokens(spark, str(tmp_path / "t.jsonl")).collect()
    rows = spark.createDataFrame([("B", 0), ("a", 1), ("a", 0)], "source_path string, row_index long")
    assert [tuple(r) for r in readers.first_rows(rows, 2).collect()] == [("a", 0), ("a", 1)] and readers.first_rows(rows, None).count() == 3


def test_eval_registry_holds_metadata_alone(spark):
    df = spark.createDataFrame([("e", "secret question", 5, "available")], "id string, content string, row_count long, availability string")
    got = json.loads(sinks.eval_registry(df))
    assert got["evaluations"] == [{"id": "e", "row_count": 5, "availability": "available"}] and "secret" not in json.dumps(got)


def test_equal_lines_are_rows_of_their_own(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"user": "q", "assistant": "a"}\n\n' + '{"user": "q", "assistant": "a"}\n' * 2)
    args = (str(tmp_path / "in"), "ds", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert ingest.ingest(spark, *args) == 3
    assert sorted(r["source_row_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a.jsonl#1", "a.jsonl#3", "a.jsonl#4"]


def test_best_row_of_each_key(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "k", 5.0), (2, "2024-01-01 01:00:00", "k", 9.0), (3, "2024-01-02 01:00:00", "k", 1.0)], "id long, t string, key string, q double").withColumn("t", F.to_timestamp("t"))
    got = {(r["winner_id"], r["copies"]) for r in ingest.best_stream(df, "t", "key", F.col("q"), "id").collect()}
    assert got == {(2, 2), (3, 1)}


def test_finished_stage_with_other_details_runs_again(tmp_path):
    s = stages.Stages(str(tmp_path / "s.json"))
    s.mark("x", "PASS", inputs="i", config="c", max_rows=5)
    assert s.can_skip("x", "i", "c", {"max_rows": 5}) and not s.can_skip("x", "i", "c", {"max_rows": 6}) and not s.can_skip("x", "j", "c")


def test_jsonl(spark, drop):
    rows = readers.read_jsonl(spark, f"{drop}/v1.2", "ds", drop).collect()
    train = {r["row_index"]: r for r in rows if "train" in r["source_path"]}
    assert sorted(train) == [0, 1, 3, 4, 5, 6, 7] and train[3]["source_row_id"] == "v1.2/train.jsonl#4"
    assert train[6]["_parse_error"] and train[6]["raw"] is None and train[7]["_invalid_row"] and json.loads(train[5]["raw"])["user"] == "q5"
    assert [r["row_index"] for r in rows if "test" in r["source_path"]] == [0]


def test_line_numbers_across_blocks(spark, tmp_path):
    (tmp_path / "big.jsonl").write_text("".join(f'{{"n": {i}}}\n' for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = readers.numbered_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert df.where(F.get_json_object("value", "$.n").cast("long") != F.col("line")).count() == 0 and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_listing_inference_and_card(spark, drop):
    files = [r["source_path"] for r in readers.list_files(spark, drop).collect()]
    assert files == ["v1.2/test.jsonl.gz", "v1.2/train.jsonl"]
    df = spark.createDataFrame([("v1.2/train.jsonl",), ("a/ultra-v2_code_ja-00.parquet",), ("agent_traces/my_eval.jsonl.gz",), ("x/plain.jsonl",)], "p string")
    got = [tuple(r) for r in df.select(inference.config_of("p"), inference.split_of("p")).collect()]
    assert got == [("v1.2", "train"), ("default", "code_ja"), ("agent_traces", "eval"), ("default", "plain")]
    assert readers.dataset_card(spark, f"{drop}/README.md") == {"license": "mit"}


def test_cursor(spark, drop):
    rows = readers.read_jsonl(spark, f"{drop}/v1.2", "ds", drop)
    left = readers.after_cursor(rows, "v1.2/train.jsonl#5").collect()
    assert sorted(r["row_index"] for r in left) == [5, 6, 7]
    with pytest.raises(ValueError, match="not found"):
        readers.after_cursor(rows, "v1.2/train.jsonl#3")
    with pytest.raises(ValueError, match="invalid"):
        readers.after_cursor(rows, "nonsense")


def test_parquet_rows_and_events(spark, tmp_path):
    spark.range(10).withColumn("text", F.lit("x")).coalesce(1).write.parquet(str(tmp_path / "p"))
    got = readers.read_parquet(spark, str(tmp_path / "p"), "ds", start_row=7).collect()
    assert sorted(json.loads(r["raw"])["id"] for r in got) == [7, 8, 9]
    ev = readers.event_files(readers.read_parquet(spark, str(tmp_path / "p"), "ds")).first()
    assert ev["n_events"] == 10 and [e["id"] for e in json.loads(ev["raw"])["_event_stream"]] == list(range(10))


def test_containers_and_logical_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"questions": [{"q": "x"}, {"q": "y"}]}')
    (tmp_path / "b.json").write_text('[{"q": "z"}]')
    assert sorted(r["q"] for r in readers.read_json(spark, str(tmp_path), "q string").collect()) == ["x", "y", "z"]
    files = spark.createDataFrame([("d", "agent_traces/a.jsonl"), ("d", "b.jsonl"), ("e", "c.jsonl")], "dataset_id string, source_path string")
    assert sorted(r["source_path"] for r in readers.logical_files(files, ["dataset_id"]).collect()) == ["agent_traces/a.jsonl", "c.jsonl"]
    m = inference.turns(F.col("r"))
    df = spark.createDataFrame([('{"turns": ["a", "b"]}',), ('{"choices": [{"turns": ["c"]}, {"turns": ["d"]}]}',), ("{}",)], "r string")
    assert [r[0] for r in df.select(m).collect()] == ["a\nb", "c\nd", ""]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, ["x"]), ("b", 3, [])], "source_dataset string, mass long, tags array<string>")
    sinks.write_candidates(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).columns == ["source_dataset", "mass", "tags_json"]
    for _ in range(2):
        sinks.commit_chunk(df, str(tmp_path / "k"), 0)
        sinks.commit_chunk(df, str(tmp_path / "k"), 1)
    assert spark.read.parquet(str(tmp_path / "k")).count() == 4
    sinks.write_audit(df, str(tmp_path / "a"))
    assert spark.read.json(str(tmp_path / "a")).count() == 2
    with pytest.raises(ValueError, match="raw text"):
        sinks.write_audit(df.withColumn("text", F.lit("x")), str(tmp_path / "no"))
    assert json.loads(sinks.manifest(df, "source_dataset", "mass"))["sources"][0] == {"id": "b", "mass": 3, "percent": 75.0}
    small = df.select("source_dataset", "mass").orderBy("mass")
    assert sinks.to_csv(small) == "source_dataset,mass\na,1\nb,3\n" and "| a | 1 |" in sinks.to_markdown("T", small) and "<td>b</td>" in sinks.to_html("T", small)
    assert sinks.drop_samples({"samples": 1, "files": [{"samples": 2, "rows": 3}]}) == {"files": [{"rows": 3}]}


def test_stream_ingest_resumes(spark, drop, tmp_path):
    args = (f"{drop}/v1.2", "ds", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert ingest.ingest(spark, *args) == 8
    assert ingest.ingest(spark, *args) == 8
    with open(f"{drop}/v1.2/more.jsonl", "w") as f:
        f.write('{"user": "n", "assistant": "m"}\n')
    assert ingest.ingest(spark, *args) == 9


def test_stage_state(tmp_path):
    path = str(tmp_path / "state.json")
    s = stages.Stages(path)
    ran = []
    assert s.run("a", lambda: ran.append(1), "in", {"x": 1}) == "PASS"
    assert stages.Stages(path).run("a", lambda: ran.append(1), "in", {"x": 1}) == "PASS" and ran == [1]
    assert stages.Stages(path).run("a", lambda: ran.append(1), "in", {"x": 2}) == "PASS" and ran == [1, 1]

    def blocked():
        raise stages.Blocked("no evals")

    assert s.run("b", blocked, "in", {}) == "BLOCKED" and s.run("c", lambda: 1 / 0, "in", {}) == "ERROR"
    s.mark("d", "RUNNING")
    assert stages.Stages(path).state["d"]["state"] == "PARTIAL"
