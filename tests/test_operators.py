import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from gristmill.functions import hashing as H
from gristmill.functions import text as X
from gristmill.operators import audits, contamination, dedup, filters, governance, quality, records, selection, validate


def one(spark, df_row, schema, *cols):
    return spark.createDataFrame([df_row], schema).select(*cols).first()


# text
@pytest.mark.parametrize(
    ("text", "label"),
    [("これは日本語の文章です。", "japanese"), ("これは Japanese explanation です。", "mixed"), ("def add(a, b): return a + b", "code-heavy"), ("Plain words in English.", "english"), ("", "unknown"), (None, "unknown")],
)
def test_language(spark, text, label):
    row = one(spark, (text,), "t string", X.language(X.char_stats("t"))["language"].alias("l"))
    assert row["l"] == label


def test_normalize_matches_python(spark):
    texts = ["  A　b\x1cc \n D ", "Straße", "", None, "x\tY", "ＦＵＬＬ　ｗｉｄｔｈ １２", "ﬁne ﬂow", "ẞ İ ς Σ", "①②", "ｶﾞ", "e\u0301", "漢字かなカナー「」", "Ça va – «oui»", "µ ª ½", "Привет Ё", "a\u00adb\u3000\x85c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["a"], r["b"]) for r in df.select("i", X.normalize("t").alias("a"), X.normalize_nfkc("t").alias("b")).collect()}
    for i, t in enumerate(texts):
        want = " ".join(unicodedata.normalize("NFKC", t or "").casefold().split())
        assert got[i] == (want, want if t is not None else None)


def test_token_estimate(spark):
    df = spark.createDataFrame([("",), (None,), ("a",), ("abc",)], "t string")
    assert [r[0] for r in df.select(X.token_estimate("t")).collect()] == [0, 0, 1, 2]


def test_top_line_share(spark):
    share, n = X.top_line_share("t")
    row = one(spark, ("b\n a \na\n\nc",), "t string", share.alias("s"), n.alias("n"))
    assert (row["s"], row["n"]) == (0.5, 4)


def test_grams_and_windows(spark):
    row = one(spark, ("héllo😀x",), "t string", H.grams("t", 3).alias("g"), H.grams("t", 20).alias("w"), H.grams(F.lit(""), 3).alias("e"), H.windows("t", 3, 2).alias("v"))
    assert row["g"] == ["hél", "éll", "llo", "lo😀", "o😀x"]
    assert row["w"] == ["héllo😀x"] and row["e"] == [] and row["v"] == ["hél", "llo", "o😀x"]


def test_simhash_against_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 700))) for _ in range(30)] + ["", "ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r["id"]: r["simhash"] for r in dedup.simhash(df, "id", F.col("t")).collect()}
    for i, t in enumerate(texts):
        n = len(t) - 2
        step = max(1, -(-n // 256))
        grams = [t[k : k + 3] for k in range(0, n, step)] if n > 0 else [t] if t else []
        hs = [int(hashlib.md5(g.encode()).hexdigest()[:16], 16) for g in grams]
        want = sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) >= len(hs))
        assert got[i] & (2**64 - 1) == want


def test_simhash_of_an_id_with_many_rows(spark):
    df = spark.createDataFrame([(1, "a" * 258)] * 300 + [(2, "a" * 258)], "id long, t string")
    got = {(r["id"], r["simhash"] & (2**64 - 1)) for r in dedup.simhash(df, "id", F.col("t")).collect()}
    want = int(hashlib.md5(b"aaa").hexdigest()[:16], 16)
    assert got == {(1, want), (2, want)}


def simhash_text_brute(t):
    t = unicodedata.normalize("NFKC", t)
    if len(t) > 4096:
        t = t[:2048] + "\n<simhash-window>\n" + t[-2048:]
    n = max(0, len(t) - 2)
    votes = [0] * 64
    for g in [t[i : i + 3] for i in range(0, n, max(1, (n + 255) // 256))] or [t]:
        v = int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big")
        for b in range(64):
            votes[b] += 1 if v >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] >= 0)


def test_published_signatures(spark):
    texts = ["", "a", "ab", "abc", "ｆｕｌｌ ﬁ width", "é日本" * 2000, "x y z " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r["id"]: r["simhash"] & (2**64 - 1) for r in dedup.simhash_text(df, "id", F.col("t")).collect()}
    assert got == {i: simhash_text_brute(t) for i, t in enumerate(texts)}


def test_exact_dedup_keeps_the_best_record(spark):
    rng = random.Random(8)
    rows = [(f"r{i}", f"h{rng.randrange(9)}", rng.random() < 0.8, i, rng.choice(["", "unknown", "v1", None]), rng.choice(["mit", "unknown", None]), rng.random() < 0.5, rng.choice([None, 1.0, 2.0]), rng.choice("ab"), rng.choice(["1", "2"])) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id string, content_hash string, eligibility boolean, seq long, source_revision string, license_raw string, schema_complete boolean, quality_score double, source_dataset string, source_row_id string")
    best = {}
    key = lambda r: (r[4] not in (None, "", "unknown"), r[5] not in (None, "", "unknown"), r[6], r[7] or 0.0, r[8], r[9])
    for r in rows:
        if r[2] and (r[1] not in best or key(r) > key(best[r[1]])):
            best[r[1]] = r
    got = dedup.exact_deduplicate(df.repartition(3)).collect()
    assert len(got) == sum(r[2] for r in rows)
    assert all(r["winner_id"] == best[r["content_hash"]][0] and r["is_winner"] == (r["duplicate_of"] is None) == (r["record_id"] == r["winner_id"]) for r in got)


def test_near_edges_are_lossless_and_greedy_is_sequential(spark):
    rng = random.Random(5)
    sigs = []
    for _ in range(25):
        base = rng.getrandbits(64)
        sigs += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(5)]
    signed = [s - 2**64 if s >> 63 else s for s in sigs]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, simhash long")
    got = {(r["sig_a"], r["sig_b"]) for r in dedup.near_edges(df, "id").collect()}
    want = {(min(a, b), max(a, b)) for a in set(signed) for b in set(signed) if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert got == want
    accepted, verdict = [], {}
    for i, s in enumerate(sigs):
        by = next((j for j in accepted if bin(s ^ sigs[j]).count("1") <= 3), None)
        verdict[i] = by
        if by is None:
            accepted.append(i)
    rows = {r["id"]: r for r in dedup.greedy_near(df, "id").collect()}
    assert {i for i, r in rows.items() if r["accepted"]} == set(accepted)
    assert {i: r["duplicate_of"] for i, r in rows.items()} == verdict


def test_near_edges_are_merged_and_come_once(spark):
    """The keys are twenty times the signatures, so they are never broadcast; all six blocks of a pair may meet."""
    rng = random.Random(6)
    base = rng.getrandbits(62)
    df = spark.createDataFrame([(i, base ^ (1 << i)) for i in range(60)] + [(60, base), (61, base)], "id long, simhash long")
    edges = dedup.near_edges(df, "id")
    got = [(r["sig_a"], r["sig_b"]) for r in edges.collect()]
    plan = edges._jdf.queryExecution().executedPlan().toString()  # as it ran
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert len(got) == len(set(got)) == 61 * 60 // 2


def test_greedy_near_broadcasts_nothing(spark):
    """Its tables grow with the input, and a broadcast gathers them on the driver."""
    rng = random.Random(7)
    base = [rng.getrandbits(62) for _ in range(20)]
    df = spark.createDataFrame([(i, base[i % 20] ^ (1 << i % 3)) for i in range(90)], "id long, simhash long")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = dedup.greedy_near(df, "id")
    rows = out.collect()
    assert len(rows) == 90 and sum(r["accepted"] for r in rows) == 20
    plans = [store.executionsList(before, 1000).apply(k).physicalPlanDescription() for k in range(store.executionsCount() - before)]
    plans.append(out._jdf.queryExecution().executedPlan().toString())  # as it ran
    assert sum("SortMergeJoin" in p for p in plans) > 3
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_running_winner(spark):
    df = spark.createDataFrame([("h", 1, 5.0), ("h", 2, 5.0), ("h", 3, 9.0), ("h", 4, 1.0), ("g", 5, 1.0)], "h string, seq long, q double")
    got = {r["seq"]: r["duplicate_of"] for r in dedup.running_winner(df, "h", [F.col("q")], "seq", "seq").collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: 3, 5: None}


# records
def canonical(spark, *raws):
    df = spark.createDataFrame([("fixture", f"train.jsonl#{i}", r) for i, r in enumerate(raws)], "dataset_id string, source_row_id string, raw string")
    return {r["source_row_id"]: r for r in records.canonicalize(df).collect()}


def test_reasoning_is_split_from_the_answer(spark):
    raw = json.dumps({"instruction": "質問", "output": "<think>途中の推論</think>最終回答です。", "model": "teacher-x"}, ensure_ascii=False)
    r = canonical(spark, raw)["train.jsonl#0"]
    assert (r["user"], r["reasoning"], r["assistant_final"], r["teacher_model"]) == ("質問", "途中の推論", "最終回答です。", "teacher-x")
    assert len(r["record_hash"]) == 64


def test_message_shapes(spark):
    raws = [
        {"messages": [{"role": "developer", "content": "s"}, {"role": "human", "content": " u "}, {"role": "model", "content": [{"text": "a"}, "b"]}, {"role": "alien", "content": "x"}, {"role": "user", "content": ""}]},
        {"row_json": json.dumps({"conversations": [{"from": "human", "value": "q"}, {"from": "assistant", "value": "r"}]}), "model": "m"},
        {"messages": [], "question": {"text": "q2"}, "answer": "a2"},
    ]
    got = canonical(spark, *map(json.dumps, raws), "bad json", "[1]")
    a, b, c, bad = (got[f"train.jsonl#{i}"] for i in range(4))
    assert [(m["role"], m["content"]) for m in a["messages"]] == [("system", "s"), ("user", "u"), ("assistant", "a\nb")]
    assert (b["user"], b["assistant_final"], b["teacher_model"]) == ("q", "r", "m")
    assert (c["user"], c["assistant_final"]) == ("q2", "a2")
    assert bad["parse_error"] and bad["messages"] == [] and a["parse_error"] is None


def test_broken_rows_are_kept_and_marked(spark):
    df = spark.createDataFrame([("u", "a" * 50, None, "x"), ("u", "a" * 50, None, None)], "user string, assistant_final string, system string, err string")
    got = [r[0] for r in df.select(filters.reasons(error="err")).collect()]
    assert got == [["broken_json"], []]


@pytest.mark.parametrize(
    ("answer", "reason"),
    [("", "empty_assistant"), ("N/A.", "placeholder_answer"), ("I cannot do that", "refusal_only"), ("Traceback (most recent call last): x", "stack_trace_only"), ("ok" + "�" * 3, "unicode_corruption"), ("a\x01b\x02", "control_character_corruption"),
     ("a\na\na\nb", "meaningless_repetition"), ("<html>" + "x" * 50, "html_navigation_garbage"), ("AKIA" + "A" * 16, "secret_like_string"), ("/home/a/ /Users/b/", "private_path_exposure")],
)
def test_reasons(spark, answer, reason):
    row = one(spark, ("q", answer), "user string, assistant_final string", filters.reasons().alias("r"))
    assert reason in row["r"]


def test_reasons_of_role_and_metadata(spark):
    row = one(spark, ("q", "fine answer", "eval_only", "test", "gsm8k"), "user string, assistant_final string, role string, split string, meta string", filters.reasons(role="role", split="split", metadata="meta").alias("r"))
    assert row["r"] == ["eval_split_not_train", "forbidden_source_role", "benchmark_or_eval_signal", "eval_only_source"]


def test_quality_of_a_plain_record(spark):
    m = [("user", "question"), ("assistant", "answer " * 10)]
    df = spark.createDataFrame([("question", "answer " * 10, "general", m)], "user string, assistant_final string, category string, messages array<struct<role:string,content:string>>")
    p = quality.parts(category="category", messages=F.col("messages"))
    row = df.select(*[c.alias(n) for n, c in p.items()]).withColumn("total", quality.total(list(p))).first()
    assert (row["structural"], row["linguistic"], row["completeness"], row["usefulness"], row["format_integrity"]) == (20, 12, 17, 15, 10)
    assert row["total"] == round(sum(row[k] for k in p), 3)


# contamination
def con(spark, cand, evals, **kw):
    c = spark.createDataFrame([(i, t, None) for i, t in enumerate(cand)], "id long, text string, prompt string")
    e = spark.createDataFrame([(i, t, None) for i, t in enumerate(evals)], "id long, text string, prompt string")
    return {r["id"]: r for r in contamination.classify(c, e, **kw).collect()}


LONG = "The quick brown fox jumps over the lazy dog while seven wizards quietly judge the boxing match near the river bank today."


def test_classifier_precedence(spark):
    near = LONG.replace("seven", "eight")
    rows = con(spark, [LONG.upper(), "x " + LONG + " y", "unrelated words entirely, nothing shared with anything at all here", "", None, near, "about mt-bench"], [LONG])
    assert [rows[i]["status"] for i in range(5)] == ["quarantine_exact", "quarantine_exact", "clean", "excluded_empty_projection", "excluded_empty_projection"]
    assert rows[0]["reasons"] == ["full_content_sha256"] and rows[1]["reasons"] == ["long_substring_ge_80"]
    assert rows[5]["status"] in ("quarantine_near", "requires_manual_review") and rows[5]["matched_eval_ids"] == [0]
    assert rows[6]["status"] == "requires_manual_review"


def test_shifted_passage_needs_the_exhaustive_probe(spark):
    shifted = "zzzz" + LONG[3:]
    assert con(spark, [shifted], [LONG], near=False)[0]["status"] == "quarantine_exact"
    assert con(spark, [shifted], [LONG], near=False, exhaustive=False)[0]["status"] == "clean"


def test_scan_without_evals_fails_closed(spark):
    c = spark.createDataFrame([(1, "a")], "id long, text string")
    assert contamination.scan(c, c.where("false")).first()["status"] == "not_checked_missing_eval_source"
    gated = contamination.gate(contamination.classify(c.withColumn("prompt", F.lit("")), c.withColumn("prompt", F.lit("")).withColumn("text", F.lit(LONG)), near=False), True)
    assert gated.first()["status"] == "not_checked_missing_eval_source"


def test_substring_pairs_against_brute_force(spark):
    rng = random.Random(2)
    evals = ["".join(rng.choice("ab ") for _ in range(rng.choice([20, 45, 60]))) for _ in range(8)]
    cand = [e[rng.randint(0, 9) :][: rng.randint(0, 60)] for e in evals for _ in range(3)] + ["q" + e + "r" for e in evals] + ["", "a"]
    df = lambda xs: spark.createDataFrame(list(enumerate(xs)), "id long, norm string")
    got = {(r["id"], r["eval_id"]) for r in contamination.substring_pairs(df(cand), df(evals)).collect()}
    assert got == {(i, j) for i, c in enumerate(cand) for j, e in enumerate(evals) if len(e) >= 40 and (c in e or e in c)}


# selection
def test_token_prefix_includes_the_crossing_row_and_is_stable(spark):
    df = spark.createDataFrame([(i, "b", 10) for i in range(5)], "id long, b string, tokens long")
    pick = lambda: sorted(r["id"] for r in selection.token_prefix(df.withColumn("k", selection.sample_key(3407, "id")), "k", "tokens", 15, ["b"]).collect())
    assert len(pick()) == 2 and pick() == pick()


def test_allocation_keeps_every_stratum_and_the_total(spark):
    df = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), ("d", 0)], "s string, n long")
    got = {r["s"]: r["allocated"] for r in selection.allocate(df, "s", "n", 20).collect()}
    assert sum(got.values()) == 20 and min(got.values()) >= 1 and "d" not in got
    assert {r["s"]: r["allocated"] for r in selection.allocate(df, "s", "n", 2).collect()} == {"a": 1, "b": 1, "c": 0}


def test_stratified_selection_respects_targets_and_families(spark):
    rows = [(f"r{i}", "general_japanese", f"s{i % 3}", f"f{i % 30}", 50) for i in range(400)]
    df = spark.createDataFrame(rows, "record_id string, bucket string, stratum string, family string, tokens long")
    got = selection.stratified_by_mass(df, 10_000).toPandas()
    target = 3000
    assert got["tokens"].sum() <= target and got.groupby("family")["tokens"].sum().max() <= target * 0.05
    again = selection.stratified_by_mass(df.repartition(7), 10_000).toPandas()
    assert sorted(got["record_id"]) == sorted(again["record_id"])


def test_length_buckets(spark):
    df = spark.createDataFrame([(4096,), (4097,), (32768,), (32769,)], "n long")
    assert [r[0] for r in df.select(selection.length_bucket("n")).collect()] == ["short", "medium", "long", "extra_long"]


def test_token_stats_histogram(spark):
    df = spark.createDataFrame([("g", n) for n in (500, 1500, 5000, 9000, 40000, None)], "g string, tokens long")
    row = audits.token_stats(df, ["g"], "tokens").first()
    assert (row["rows"], row["tokens"], row["max_tokens"]) == (5, 56000, 40000)
    assert [row[c] for c in ("le_1024", "le_4096", "le_8192", "le_32768", "gt_32768")] == [1] * 5


# validators
def test_segment_keeps_tool_pairs():
    trace = [("user", 1), ("assistant", 1), ("tool", 1), ("assistant", 1)]
    assert validate.segment(trace, 3) == ([(0, 3), (3, 4)], "segmented")
    assert validate.segment(trace, 9) == ([(0, 4)], "single_turn_boundary_safe")
    assert validate.segment([("user", 9)], 3) == ([], "long_trace_unsegmented")
    assert validate.segment([], 3) == ([], "messages_missing")


def test_trace_and_training_errors(spark):
    kind = "m array<struct<role:string,content:string>>, f string"
    rows = [([("user", "q"), ("tool", "t")], ""), ([], "x"), ([("user", "q"), ("assistant", "<think>a")], "a"), ([("user", "q"), ("assistant", "a"), ("tool", "t"), ("assistant", "b")], "b")]
    df = spark.createDataFrame(rows, kind)
    trace = [r[0] for r in df.select(validate.trace_errors("m")).collect()]
    assert trace == [["assistant_missing", "tool_without_preceding_assistant", "trace_ends_with_tool_result"], ["messages_missing"], [], []]
    train = [r[0] for r in df.select(validate.training_errors("m", "f")).collect()]
    assert train[0] == ["assistant_role_missing", "final_answer_field_missing", "final_answer_missing", "tool_result_pair_missing"]
    assert train[2] == ["think_tag_unbalanced"] and train[3] == []


# governance
def test_governance(spark):
    reg = spark.createDataFrame([("a", "train_candidate", "approved", "chat", "r/a"), ("b", "eval_only", "approved", "chat", "r/b"), ("b", "x", "y", "", "")], "id string, role string, status string, category string, repo string")
    codes = {(r["code"], r["subject"]) for r in governance.registry_issues(reg).collect()}
    assert {("protected_dataset_not_locked", "b"), ("approved_role_invalid", "b"), ("unknown_role", "b"), ("duplicate_dataset_id", "b")} <= codes
    assert not [c for c in codes if c[1] == "a"]
    fields = {f: "x" for f in governance.MANIFEST_FIELDS} | {"dataset_id": "a", "contamination_status": "clear", "category": "chat", "source_repo": "r/a", "license": "unknown"}
    man = spark.createDataFrame([{**fields, "schema_version": 1, "manifest_sha256": "0" * 64, "actual_sha256": "1" * 64, "n_records": 1}])
    got = {r["code"] for r in governance.manifest_issues(reg.where("id = 'a'"), man).collect()}
    assert got == {"manifest_field_unknown", "manifest_hash_mismatch"}
    assert governance.exit_code(["PASS", "BLOCKED"]) == 2 and governance.exit_code(["ERROR", "BLOCKED"]) == 1 and governance.exit_code(["PASS"]) == 0
    assert governance.within_budget(1, 150, 2, 300) and not governance.within_budget(1, 150, 3, 300)


# contamination by NFKC form
def test_probe_finds_every_key(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab 漢😀") for _ in range(rng.randint(0, 60))) for _ in range(80)] + ["", None]
    keys = {t[i : i + 5] for t in texts[:20] if t for i in range(0, max(1, len(t) - 4), 3)} | {"ab", ""}
    cand = spark.createDataFrame(list(enumerate(texts)), "id long, norm string")
    k = spark.createDataFrame([(x,) for x in keys], "k string")
    want = {(i, t[j : j + 5]) for i, t in enumerate(texts) if t for j in range(max(1, len(t) - 4)) if t[j : j + 5] in keys}
    for most in (contamination.PROBE_KEYS, 0):
        got = contamination.probe(cand, k, 5, most).join(k, "k", "left_semi").collect()
        assert {(r["id"], r["k"]) for r in got} == want and len(got) == len(want)
    assert contamination.probe(cand, k.where("false"), 5).count() == 0


def test_contamination_sees_compatibility_forms(spark):
    text = "what is the final answer of this benchmark question about finite fields and efficient flows of rivers"
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else "\u3000" for c in text.upper())
    ligature = text.replace("fi", "ﬁ").replace("fl", "ﬂ").replace("ffi", "ﬃ")
    cand = spark.createDataFrame([(1, wide, ""), (2, f"before {ligature} after", ""), (3, "nothing of the kind stands here at all", "")], "id long, text string, prompt string")
    evals = spark.createDataFrame([(9, text, "")], "id long, text string, prompt string")
    scan = {r["id"]: (r["status"], r["reasons"]) for r in contamination.scan(cand.select("id", "text"), evals.select("id", "text")).collect()}
    assert scan[1][0] == scan[2][0] == "quarantine_contamination" and scan[3] == ("clear", [])
    assert "exact_eval_match" in scan[1][1] and "substring_eval_match" in scan[2][1]
    status = {r["id"]: (r["status"], r["reasons"]) for r in contamination.classify(cand, evals).collect()}
    assert status[1] == ("quarantine_exact", ["full_content_sha256"]) and status[2] == ("quarantine_exact", ["long_substring_ge_80"]) and status[3][0] == "clean"


def test_empty_eval_content_is_an_error(spark):
    evals = spark.createDataFrame([(1, "text", "p"), (2, " \u3000 ", "")], "id long, text string, prompt string")
    for build in (lambda: contamination.fingerprint_index(evals), lambda: contamination.classify(evals, evals)):
        with pytest.raises(contamination.EmptyContent):
            build()
    row = contamination.fingerprint_index(evals.where("id = 1")).first()
    assert row["prompt_hash"] == hashlib.sha256(b"p").hexdigest() and len(row["minhash"]) == 128 and row["normalized_length"] == 4 and "text" not in row.asDict()


def test_hit_axes_reconcile(spark):
    hits = spark.createDataFrame([("a", "a/x/1.jsonl#3", "e", "c1"), ("a", "a/x/2.jsonl#1", "f", "c1"), ("b", "b/y/1.jsonl#1", "e", "c2")], "source string, source_row_id string, eval string, cluster string")
    made = audits.hit_decomposition(hits)
    got = {(r["axis"], r["key"]): r["n"] for r in made.collect()}
    assert got[("family", "a/x")] == 2 and got[("file", "a/x/1.jsonl")] == 1 and got[("source_x_eval", "a|e")] == 1 and got[("cluster", "c1")] == 2 and got[("total", "")] == 3
    audits.require_reconciled(made)
    with pytest.raises(ValueError, match="file"):
        audits.require_reconciled(made.where("key <> 'a/x/1.jsonl'"))


def test_contamination_record_canonicalizes_only_what_is_scanned(spark):
    raw = json.dumps({"user": "q", "assistant": "a"})
    df = spark.createDataFrame([("d", "1", raw, "scan"), ("d", "2", raw, "metadata_only")], "dataset_id string, source_row_id string, raw string, disposition string")
    got = {r["source_row_id"]: r for r in records.contamination_record(df).collect()}
    assert (got["1"]["user"], got["1"]["assistant_final"]) == ("q", "a") and got["2"]["messages"] == [] and got["2"]["user"] == ""
    assert got["2"]["record_id"] == hashlib.sha256(b"d:2").hexdigest()


def test_near_check_reads_every_position(spark):
    """The eval text moved by a character shares no gram at an even stride, but all but one of its grams."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = " ".join(word() for _ in range(400))
    cut = " ".join(w if i % 8 else word() for i, w in enumerate(text.split()))  # no window of 80 characters survives
    other = " ".join(word() for _ in range(400))
    c = spark.createDataFrame([(1, "q" + text), (2, "q" + cut), (3, other), (4, text[:200])], "id long, norm string")
    got = {r["id"]: r for r in contamination.near_pairs(c, spark.createDataFrame([(7, text)], "id long, norm string")).collect()}
    assert set(got) == {1, 2} and got[1]["similarity"] > 0.95 and got[1]["eval_id"] == 7
    status = con(spark, ["q" + cut, other], [text])
    assert status[0]["status"] != "clean" and status[1]["status"] == "clean"


#: Texts of an odd kind, and eval texts that hold them, stand in them or share a part.
ODD = [LONG, "x" + LONG.upper() + " y", LONG[5:70], "seven wizards", "box", "b", "", None, "  \n", "ﾊﾝｶｸ " + LONG[:60], LONG[:50] + "zz" + LONG[50:], "Straße " * 9, "the quick brown", LONG[:12], "¨", "mt-bench"]
ODD_EVALS = [LONG, "strasse " * 9, "b", LONG[:12], LONG[20:], "Nothing of these texts is in this line, whoever may look for it; it is rather long, too."]


def test_sweep_equals_the_joins(spark, monkeypatch):
    c = spark.createDataFrame([(i, t, t and t[:20]) for i, t in enumerate(ODD)], "id long, text string, prompt string")
    e = spark.createDataFrame([(i, t, t[:20]) for i, t in enumerate(ODD_EVALS)], "id long, text string, prompt string")
    n = e.select("id", X.normalize("text").alias("norm"))
    runs = (
        lambda: contamination.substring_pairs(c.select("id", "text"), n), lambda: contamination.gram_overlap(c.select("id", "text"), n), lambda: contamination.window_matches(c.select("id", "text"), n),
        lambda: contamination.shared_keys(c.select("id", "text"), n, 13), lambda: contamination.shared_counts(c.select("id", "text"), n, 24),
        lambda: contamination.scan(c.select("id", "text"), e.select("id", "text")), lambda: contamination.classify(c, e, near=False), lambda: contamination.classify(c, e),
    )
    swept = [sorted(map(str, run().collect())) for run in runs]
    assert all(swept)
    monkeypatch.setattr(contamination, "SWEEP_CHARS", -1)
    assert [sorted(map(str, run().collect())) for run in runs] == swept


@pytest.mark.parametrize(("name", "most"), [("con7_scan", 2), ("con7_summary", 2), ("agg12_status_counts", 2), ("con5_exact_status", 2), ("con6_gate", 2), ("jn7_substring_pairs", 1), ("jn6_window_probe", 1), ("set5_gram_intersection", 1), ("con3_candidates", 1)])
def test_contamination_reads_texts_once(spark, sf, name, most):
    """One pass finds all hits; a second one has the rows that have none."""
    from gristmill import catalog

    plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= most


@pytest.mark.parametrize(("name", "mark", "most"), [("prj6_prompt_answer", "parsejson", 4), ("agg3_reason_counts", "html_navigation_garbage", 1)])
def test_costly_columns_are_computed_once(spark, sf, name, mark, most):
    """Two columns of a JSON text parse it, and its row_json, once each; an explode has no filter that evaluates its array."""
    from gristmill import catalog

    plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count(mark) <= most
