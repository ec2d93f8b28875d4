"""The pipeline's rows against a plain version of its decisions."""

import itertools
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faremeld.llm import language, mixing, near_dup, secret_scan
from faremeld.llm.word_ids import WordIds

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component_id long"


def documents(spark):
    """Real texts, near and exact copies, secrets, an unlearned script, nulls, ties and repeated rows; two columns clash with results."""
    rng = random.Random(21)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(90).collect()]
    for i, (_, text, lang, source) in enumerate(rows[:12]):
        words = (text or "").split()
        if len(words) > 80:
            words[40] = "changed"
        rows += [(1000 + i, " ".join(words), lang, source), (1100 + i, text, lang, "src9")]
    rows += [(2000, 'api_key = "0123456789abcdef0123456789abcdef" for the other one and the rest of them', "en", "src1"), (2001, "12345 !!", "en", "src1"), (2002, None, None, None), (2003, "", "en", None), (2004, " \n ", "de", "src2")]
    rows += [(2005, rows[20][1], rows[20][2], "src3")] * 2 + [(None, rows[21][1] + " and more of it", "en", "src4"), (2006, (rows[22][1] + " ") * 30, rows[22][2], "src5")]
    rng.shuffle(rows)
    return [(*r, None if r[1] is None else len(r[1]), "a", 7) for r in rows]


def duck(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    names = [d[0] for d in con.execute(sql).description]
    return [dict(zip(names, r)) for r in con.fetchall()]


def masked(text, spans):
    out, at = [], 0
    for _, start, end in sorted((int(s.split(":")[1]), int(s.split(":")[1]), int(s.split(":")[2])) for s in spans.split(",") if s):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def plain(spark, rows, monkeypatch):
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    rows = [r for r in rows if (found := model.predict(r[1]))[0] != "und" and found[1] >= language.LEAST_SCORE]

    words = near_dup.WordHashes()
    kept = [r for r in rows if r[0] is not None]
    sets = [near_dup.shingles([r[1]], words)[1:] for r in kept]
    group = {r[0]: r[0] for r in kept}
    linked = [(kept[i][0], kept[j][0]) for i, j in itertools.combinations(range(len(kept)), 2) if near_dup.probability_jaccard(sets[i][0], near_dup.damped(sets[i][1]), sets[j][0], near_dup.damped(sets[j][1])) >= 0.8]
    for _ in range(len(kept)):
        before = dict(group)
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
        if before == group:
            break
    rows = [r for r in rows if r[0] is None or group[r[0]] == r[0]]

    spans = {(r["doc_id"]): r["spans"] for r in duck(secret_scan.oracle(), rows)}
    rows = [(r[0], masked(r[1], spans[r[0]]), *r[2:]) for r in rows]

    monkeypatch.setattr(mixing, "BUDGET_SHARE", 1.0)
    copies = Counter(r["doc_id"] for r in duck(mixing.oracle(), rows))
    texts = {r[0]: r[1] for r in rows}
    ids, out = WordIds(), []
    for doc_id, n in copies.items():
        whole = ids.whole(texts[doc_id]) + bytes(4)
        for start in range(0, len(whole) // 4, 2048):
            part = whole[4 * start : 4 * (start + 2048)]
            out += [(doc_id, start // 2048, start, len(part) // 4, zlib.crc32(part))] * n
    return sorted(out, key=str)


def test_pipeline_rows_match_the_plain_version(spark, tmp_path, monkeypatch):
    rows = documents(spark)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = plain(spark, rows, monkeypatch)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == want
    for _, places in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in places:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


@pytest.mark.parametrize("kept", ["false", "text IS NULL"])
def test_pipeline_of_nothing(spark, tmp_path, kept):
    spark.createDataFrame(documents(spark), SCHEMA).where(kept).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns(spark):
    docs = spark.createDataFrame(documents(spark), SCHEMA).where(F.col("doc_id") < 30)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
