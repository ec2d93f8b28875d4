"""Token counts of prefixes, phrase collocations and spelling variants against plain versions."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from faremeld.llm import collocation, spelling, token_prefix

SCHEMA = "doc_id long, text string, lang string, source string, n_tokens long, word string, h1 long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows, names that clash with results."""
    return table(spark, [(1, None, None), (2, "", "en"), (3, "lorem ipsum dolor " * 9000, "en"), (3, "lorem ipsum dolor " * 9000, "en"), (None, "spelled spellled", "fr"), (4, "x" * 3_000 + "é" * 200, "de"), (4, "x" * 3_000 + "é" * 200, "de"), (5, " \n\t. ", None)])


# ---- 11


@pytest.fixture(scope="module")
def prefixes():
    return token_prefix.PrefixTable()


def plain(prefixes, text):
    return len(prefixes.tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_its_exact_count(prefixes):
    rng = random.Random(11)
    odd = ["it's don't 've they're we'll 'l 'rx ''s 'S I'D'M", "É é ẹ́x İstanbul ΣΑΣ ﬁ a\x1cb\xa0q <|endoftext|>x a..<|endoftext|>..b <|endof<|startoftext|>>", "12.5% ½ ²", "한한 日本語テキスト हिन्दी ภาษา", "😀👍🏽 x", "\n\n a \t b\r\n", "strange supercalifragilistic " + "a" * 90, ""]
    letters = "aabeilst'''.-,  12<|>endoftext́éÉ\nßΣ"
    odd += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    for text in odd:
        assert list(itertools.accumulate(map(int, prefixes.changes(text)))) == [plain(prefixes, text[:k]) for k in range(1, len(text) + 1)], text


def test_a_change_beyond_one_byte_is_kept(prefixes):
    class Wide(token_prefix.PrefixTable):
        def general(self, item):
            return [300] if item == "ß\u0301" else super().general(item)

    wide = Wide()
    assert wide.changes("a ß\u0301 b").tolist() == [1, 0, 300, 0, 1]


def test_stored_counts_answer_questions(spark, edge, prefixes):
    text = "Counting tokens of prefixes, isn't it strange? " * 3
    docs = edge.select("doc_id", "text", "lang").union(spark.createDataFrame([(9, text, "en")], "doc_id long, text string, lang string")).withColumn("n_tokens", F.lit("x"))
    stored = token_prefix.prefix_counts(docs)
    rows = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in stored.collect()), key=str)
    want = [(r["doc_id"], len((r["text"] or "").encode()), plain(prefixes, r["text"] or "")) for r in docs.collect()]
    assert rows == sorted(want, key=str)
    one = stored.where("doc_id = 9")
    counts = [plain(prefixes, text[:k]) for k in range(len(text) + 1)]
    asked = one.select(token_prefix.tokens_of_prefix(F.lit(17)), token_prefix.tokens_of_prefix(F.lit(0)), token_prefix.tokens_of_prefix(F.lit(10**6)), token_prefix.tokens_of_prefix(F.lit(None).cast("long")), token_prefix.longest_prefix(8), token_prefix.longest_prefix(0), token_prefix.longest_prefix(10**6)).first()
    assert tuple(asked)[:4] == (counts[17], 0, counts[-1], None)
    assert tuple(asked)[4:] == (max(k for k, c in enumerate(counts) if c <= 8), 0, len(text))
    assert token_prefix.prefix_counts(docs.limit(0)).count() == 0


def test_query_counts_whole_texts(spark, prefixes, edge, tmp_path):
    edge.write.parquet(f"{tmp_path}/documents.parquet")
    got = token_prefix.op11_prefix_token_counts(spark, str(tmp_path)).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), plain(prefixes, r["text"] or "")) for r in edge.collect()]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got), key=str) == sorted(((*w, w[2] > 2048) for w in want), key=str)
    for r in got:
        text = next(x["text"] for x in edge.collect() if x["doc_id"] == r["doc_id"]) or ""
        cut = r["kept_chars"]
        assert cut == len(text) if not r["over_limit"] else plain(prefixes, text[:cut]) <= 2048 < plain(prefixes, text[: cut + 1])


# ---- 12


def duck(sql, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con.execute(sql).fetchall(), [d[0] for d in con.description]


def phrase_rows():
    rng = random.Random(12)
    common = ["new", "york", "city", "of", "the", "Ünit"]
    rows = [(i, " ".join(rng.choice(common) for _ in range(60)) + ". New  York\tCity! the, of\x0bthe", rng.choice(["en", None, "und"])) for i in range(60)]
    return rows + [(70 + i, "a a a a a a a a a a a a b", "xx") for i in range(3)]


@pytest.mark.parametrize("groups", [1, 400])
def test_phrases_match_sql(spark, edge, tmp_path, groups, monkeypatch):
    monkeypatch.setattr(collocation, "STRETCH", 50)
    monkeypatch.setattr(collocation, "HELD_SUFFIXES", 40)
    monkeypatch.setattr(collocation, "HELD_WORDS", 6)
    docs = edge.unionByName(table(spark, phrase_rows()))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, columns = duck(collocation.oracle(), tmp_path)
    got = collocation.collocations(spark.read.parquet(f"{tmp_path}/documents.parquet"), groups=groups).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 50
    if groups == 1:
        assert collocation.collocations(docs.limit(0)).count() == 0


def test_a_hash_shared_with_a_frequent_word_changes_the_seed(spark, monkeypatch):
    true = collocation.xxhash.xxh64_intdigest

    class Clash:
        @staticmethod
        def xxh64_intdigest(data, seed):
            return 7 if seed == 0 and data.endswith((b"new", b"rare")) else true(data, seed)

    monkeypatch.setattr(collocation, "xxhash", Clash)
    words, phrases = collocation.phrase_counts(table(spark, [(1, "new york " * 20 + "rare", "en")]))
    assert {r["word"]: r["n"] for r in words.collect()} == {"new": 20, "york": 20, "rare": 1}
    assert sorted(r["n"] for r in phrases.collect()) == [19, 19, 19, 20]


# ---- 13


def slipped(doc_id, run):
    run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows):
    counts = Counter(w for i, t, *_ in rows for run in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(w := slipped(i, run)) >= 7)
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in form.items() if counts[v] >= 10 * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return sorted(out, key=str)


def variant_rows():
    rng = random.Random(13)
    rows, stems = [], ["spelling", "spellling", "speling", "aaaaaaa", "aaaaaaaa", "baaaaaaa", "éclairsà", "ÉCLAIRSà", "l" * 39, "l" * 40, "l" * 41, "l" * 42, "l" * 20 + "m" + "l" * 20, "x" * 300, "x" * 150 + "y" + "x" * 149, "x" * 299]
    for i, w in enumerate(stems):
        rows += [(1000 * i + k, f"{w}, {w.capitalize()} 7{w}") for k in range(rng.choice([1, 1, 5, 60]))]
    rows += [(90_000 + k, " ".join("".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(40))) for k in range(40)]
    rows += [(99_000 + k, "chained " * n) for k, n in enumerate([900])] + [(99_100, "chainedd " * 30 + "chaineddd chaineddd")]
    return [(i, t, "en") for i, t in rows]


def test_variants_match_all_pairs(spark, edge, tmp_path):
    docs = edge.unionByName(table(spark, variant_rows()))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in spelling.op13_spelling_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = plain_variants(rows)
    assert sorted(got, key=str) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # a chain of forms
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
