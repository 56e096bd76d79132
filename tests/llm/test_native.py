"""Secret scan, quality rules, line dedup and mixing against DuckDB, on awkward
rows, on the small table and on no rows at all."""

import duckdb
import pytest
from helpers import SMALL, awkward_rows, duck, frame, rows_of

from pyspark.sql import functions as F
from tripmart.llm import line_runs, mixing, quality, queries, secrets

RUN = {
    "op1_secret_scan": lambda d: secrets.digest(secrets.scan(d)),
    "op3_quality_rules": quality.judge,
    "op5_line_dedup": lambda d: line_runs.dedup_lines(d).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")),
    "op8_mixing": lambda d: mixing.mix(d).select(
        "doc_id", "size", "source_size", "target", "taken", "position",
        F.get("positions", F.lit(1)).alias("position_2")),
}


@pytest.mark.parametrize("name", RUN)
def test_awkward_rows(spark, name):
    rows = awkward_rows()
    got = RUN[name](frame(spark, rows)).toPandas()
    want = duck(rows, queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", RUN)
def test_no_rows(spark, name):
    assert RUN[name](frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", RUN)
def test_small_table(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert rows_of(got) == rows_of(con.execute(queries.ORACLES[name]).df())


def test_secrets_by_hand(spark):
    rows = {r["doc_id"]: r for r in RUN["op1_secret_scan"](frame(spark)).collect()}
    # "secret=token" is too short, and uses up "token"
    assert rows[4]["spans"] == "assign:0:25"
    assert (rows[5]["n_access"], rows[5]["n_hex"]) == (1, 1)
    assert "entropy_base64:4:" in rows[6]["spans"]  # a code point, not two bytes, before
    assert "hex:0:32" in rows[7]["spans"] and "entropy" not in rows[7]["spans"]
    assert rows[8]["spans"] == "hex:0:40"  # the alphabet is on the allow list


def test_mix_reaches_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = mixing.mix(docs).toPandas().merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    assert (got["taken"] <= 2 * got["size"]).all()
    per = got.groupby("source").agg(t=("taken", "sum"), want=("target", "first"),
                                    most=("size", "max"))
    assert ((per.t - per.want).abs() <= per.most / 2 + 1).all()
    placed = got[got.taken > 0]
    assert placed.position.between(0, 1).all() and placed.position.is_monotonic_increasing
    assert rows_of(got) == rows_of(mixing.mix(docs.repartition(7)).toPandas().merge(
        docs.select("doc_id", "source").toPandas(), on="doc_id"))


def test_runs_are_levelled(spark):
    runs = line_runs.LineRuns(spark, min_docs=3)
    batch = spark.range(50).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("h"))
    levels = []
    for _ in range(4):
        runs.add(batch)
        levels.append([level for level, _ in runs.runs])
    assert levels == [[0], [1], [1, 0], [2]]
    assert runs.heavy().count() == 50
    plan = runs._merged(runs.runs[0][1], runs.runs[0][1])._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]  # runs meet bucket by bucket
    runs.close()
    assert runs.runs == []


def test_lines_are_dropped_in_place(spark):
    got = {r["doc_id"]: r for r in line_runs.drop_lines(frame(spark)).collect()}
    assert got[1]["text"] is None and got[2]["text"] == ""
    assert "RESERVED" not in got[100]["text"] and got[100]["n_chars"] == len(got[100]["text"])
    assert got[100]["_doc"] == "x" and got[10]["text"] == "É line\né line\nA line\na LINE "


TOKEN = "Zk8pQ2vX7mL4tR9wB3nJ6cYd1HsF5gKa0uEoTiWx"


def test_fillers_suppress_only_what_touches_them(spark):
    texts = ["sample_" + TOKEN, "api/example/" + TOKEN, TOKEN, "x" + "xxxx" * 9, "see api/example/path/name",
             TOKEN[:30] + "XXXX" + TOKEN[:30], "the-example-1234567-sample-0000000"]
    got = [r["spans"] for r in RUN["op1_secret_scan"](frame(
        spark, [(k, t, "en", "a", 1) + ("x",) * 9 for k, t in enumerate(texts)], 1)).orderBy("doc_id").collect()]
    # a window that touches a filler does not count, one beside it does
    assert got == ["entropy_base64:6:47", "entropy_base64:11:52", "entropy_base64:0:40", "", "",
                   "entropy_base64:0:30,entropy_base64:34:64", ""]


def test_long_texts_take_time_in_proportion(spark):
    import random
    import time
    rng = random.Random(2)

    def took(make, run):
        times = []
        for n in (4000, 4000, 16_000):  # the first compiles
            rows = [(1, make(n), "en", "a", 1) + ("x",) * 9]
            docs = frame(spark, rows, 1).checkpoint()
            began = time.perf_counter()
            run(docs).collect()
            times.append(time.perf_counter() - began)
        return times[2] / times[1]

    def keys(n):
        return " ".join(f"{rng.getrandbits(128):032x}" for _ in range(n // 4))

    assert took(keys, RUN["op1_secret_scan"]) < 8  # four times the matches

    def lines(n):
        return "\n".join(f"line {k % (n // 2)} of it" for k in range(n))

    def without(docs):
        drop = F.array(*[F.unhex(F.md5(F.lit("none")))])
        every = line_runs.distinct(line_runs.line_hashes(F.col("text")))
        return docs.select(F.size(line_runs.without(line_runs.lines_of(F.col("text")), F.concat(every, drop))))

    assert without(frame(spark, [(1, lines(100) + "\n \n", "en", "a", 1) + ("x",) * 9])).first()[0] == 2
    assert took(lines, without) < 8


def test_boilerplate_is_removed(spark):
    rows = awkward_rows()
    got = {r["doc_id"]: r for r in quality.clean(frame(spark, rows), max_docs=20).collect()}
    verdict = {r["doc_id"]: r for r in quality.judge(frame(spark, rows), max_docs=20).collect()}
    assert set(got) == {k for k, r in verdict.items() if r["kept"]}
    by_id = {r[0]: r for r in rows}
    counts = {}
    for text, host in {(r[1] or "", r[3]) for r in rows}:
        for line in {_normal(x) for x in text.split("\n")} - {""}:
            counts[host, line] = counts.get((host, line), 0) + 1
    some = 0
    for k, r in got.items():
        left = [x for x in by_id[k][1].split("\n") if counts.get((by_id[k][3], _normal(x)), 0) <= 20]
        assert r["text"] == "\n".join(left) and r["n_chars"] == len(r["text"]) and r["_doc"] == "x"
        some += len(left) < len(by_id[k][1].split("\n"))
    assert some > 20
    copies = [(k, awkward_rows()[20][1], "en", "a", 1) + ("x",) * 9 for k in range(30)]
    assert quality.clean(frame(spark, copies)).count() == 30
    assert quality.clean(frame(spark, copies), copies=True).count() == 0
    assert quality.clean(frame(spark, [])).count() == 0


def _normal(line):
    import re
    return re.sub("[0-9]", "0", re.sub("[ \t-\r]+", " ", line.strip(" \t\n\x0b\x0c\r"))).lower()


def test_bucket_length_changes_no_position(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = rows_of(mixing.mix(docs).drop("positions").toPandas())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 0.01)
    assert rows_of(mixing.mix(docs).drop("positions").toPandas()) == want


def test_rows_without_an_id_are_mixed_like_others(spark):
    rows = [(None, f"{'word ' * (k % 9 + 1)}{k}", "en", "a", k) + ("x",) * 9 for k in range(300)]
    rows += [(5, "one text", "en", "a", 1) + ("x",) * 9, (5, "another text here", "en", "a", 2) + ("x",) * 9]
    docs = frame(spark, rows + rows[:40])
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    times = {}
    for r in got.collect():
        times[r["text"]] = times.get(r["text"], 0) + 1
    plan = mixing.placed_rows(docs).groupBy("_key").agg(F.sum(F.size("positions")).alias("n")).join(
        docs.select("text", *mixing.row_keys()[:1]).distinct(), "_key")
    assert times == {r["text"]: r["n"] for r in plan.collect() if r["n"]}
    placed = mixing.placed_rows(frame(spark, rows[:300])).select("position").distinct().count()
    assert placed > 150  # spread over the training, though no row has an id
