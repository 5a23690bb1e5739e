"""The pipeline's stages and their cases; __spark_entry__ with and without the subpackage."""
import random
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline as C
from rainrisk.llm.common import materialise, table

ROOT = Path(__file__).resolve().parents[2]


def test_stage_order():
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mix", "encode"]


def _docs(spark, sf="/root/testdata/sf0.01"):
    r = random.Random(1)
    prose = lambda n: " ".join("".join(r.choice("abcdeo") for _ in range(r.randint(2, 8))) for _ in range(n))
    passage = prose(120)
    rows = [(i, prose(200), "en", f"s{i % 3 if i % 2 else 0}", 0, 7) for i in range(40)]
    rows += [(50 + i, prose(150) + " " + passage + " " + prose(100), "en", "s1", 0, 7) for i in range(5)]
    base = prose(300)
    rows += [(60 + i, base if i < 3 else base + " tail" * i, "en", "s2", 0, 7) for i in range(6)]
    rows += [(80, None, None, None, None, 7), (81, "", "en", "s1", 0, 7), (None, prose(50), "en", None, 0, 7), rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, _copy int").repartition(3)


def test_stages_on_edge_rows(spark):
    docs = _docs(spark)
    near = materialise(C.near_duplicates(spark, docs, ""), "t")
    ids = sorted(r["doc_id"] for r in near.collect() if r["doc_id"] is not None)
    assert ids == [*range(40), *range(50, 55), 60, 80, 81] and near.where("doc_id is null").count() == 1
    cut = materialise(C.repeated_passages(spark, near, ""), "t")
    assert cut.columns == docs.columns and cut.count() == near.count()
    was, now = ({r["doc_id"]: r for r in d.collect()} for d in (near, cut))
    assert all(now[i]["text"] == was[i]["text"] for i in range(40))            # clean documents are left alone
    assert all(len(now[i]["text"]) < len(was[i]["text"]) - 390 for i in range(50, 55))  # the passage is gone everywhere
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in now.values() if r["doc_id"] != 80)
    mixed = materialise(C.mix(spark, cut, ""), "t")
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == set(now) and mixed.count() >= cut.count()
    out = C.encode(spark, mixed, "").collect()
    assert len(out) == mixed.count()


def test_rows_that_share_a_doc_id(spark):
    r = random.Random(6)
    prose = lambda n: " ".join("".join(r.choice("abcdeo") for _ in range(r.randint(2, 8))) for _ in range(n))
    copied = prose(80)
    rows = [(3, copied)] + [x for i in range(7, 27) for x in ((i, copied), (i, prose(80)))] + [(40, prose(80)), (40, prose(80))]
    rows += [rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(x) for x in C.near_duplicates(spark, docs, "").collect())
    assert got == sorted({(3, copied), *[x for x in rows if x[1] != copied]})


def test_mix_meets_the_target_shares(spark):
    # a hot source, some of five percent and a tiny one: shares follow a flatter target, nothing goes
    size = {"hot": 900, "a": 140, "b": 140, "c": 140, "tiny": 6}
    rows = [(1000 * k + i, "word " * 20, s) for k, (s, n) in enumerate(size.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["source"]: r["count"] for r in C.mix(spark, docs, "").groupBy("source").count().collect()}
    natural = {s: n / len(rows) for s, n in size.items()}
    totals = spark.createDataFrame([(x,) for x in natural.values()], "share double")
    alpha = C.mixing.temperature(totals, C.mixing.ENTROPY, C.mixing.MAX_REPETITION, "cover")
    p = {s: x ** alpha for s, x in natural.items()}
    assert all(abs(got[s] / sum(got.values()) - p[s] / sum(p.values())) < .01 for s in size)
    assert all(size[s] <= got[s] <= C.MAX_REPETITION * size[s] + 1 for s in size)
    assert got["tiny"] > 3.5 * size["tiny"] and got["a"] > 1.3 * size["a"]


def test_passages_of_51_words_go(spark):
    r = random.Random(3)
    prose = lambda n: " ".join("".join(r.choice("abcdeo") for _ in range(r.randint(2, 8))) for _ in range(n))
    passage = prose(51)
    assert 256 <= len(passage) < 390
    clean = {i: prose(150) for i in range(20)}
    rows = [*clean.items()] + [(50 + i, prose(90 + i) + " " + passage + " " + prose(100)) for i in range(4)]
    cut = C.repeated_passages(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    now = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(now[i] == t for i, t in clean.items())
    assert all(passage not in now[50 + i] and len(now[50 + i]) <= len(rows[20 + i][1]) - len(passage) for i in range(4))


def test_columns_with_any_name(spark):
    more = ["k", "s", "d", "sig", "a", "h", "n", "c", "tok", "row", "copies", "_n", "_STAYS", "_Score", "x.y", "pos", "rep", "copy", "Sig2"]
    docs = _docs(spark).select("doc_id", "text", "source", "n_chars", *[F.lit(i).alias(c) for i, c in enumerate(more)])
    for name, stage in C.STAGES[:-1]:
        docs = materialise(stage(spark, docs, "/root/testdata/sf0.001"), f"n-{name}")
        assert docs.columns == ["doc_id", "text", "source", "n_chars", *more]
        assert {tuple(r)[4:] for r in docs.collect()} <= {tuple(range(len(more)))}
    assert C.encode(spark, docs, "").count() == docs.count() > 0


def test_empty_table_passes_through(spark):
    docs = _docs(spark).limit(0)
    for name, stage in C.STAGES:
        docs = materialise(stage(spark, docs, "/root/testdata/sf0.001"), f"t-{name}")
        assert docs.count() == 0


def test_run_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"] for r in C.run(spark, sf).collect()}
    good = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 1").collect()}
    near = {r["doc_id"]: r["component_id"] for r in C.ngram_join.jaccard_components(table(spark, sf, "documents")).collect()}
    assert len({near[i] for i in good} - {near[i] for i in got}) <= 1  # a good document stays, itself or its like



def test_entry_imports_without_the_subpackage(tmp_path):
    for p in ("__spark_entry__.py", "rainrisk"):
        subprocess.run(["cp", "-r", str(ROOT / p), str(tmp_path)], check=True)
    code = "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'))"
    import shutil
    shutil.rmtree(tmp_path / "rainrisk" / "llm")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "[]"
