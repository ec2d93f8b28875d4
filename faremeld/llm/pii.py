"""Personal data, and the terms that reveal it: sanitisation by information content."""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import settle, table

# Forms of personal data, in the order of their kinds.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Characters on both sides of an entity whose whole words are its context, from which disclosure is estimated.
CONTEXT = 60
TERM = re.compile(r"[^\W\d_]{3,}")
#: Part of an entity's information that a term may reveal, and the documents that must show it:
#: one is enough, since most entities have no more and a word of that one document reveals all of them.
DISCLOSURE, SUPPORT = 0.75, 1
#: Bits of the fixed map that tells which words are terms; words outside it are not counted.
MAP_BITS = 1 << 22
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the leftmost addresses that don't overlap, in one pass: each `@` is looked at once, and its local part leftwards."""
    free = 0
    for m in DOMAIN.finditer(text):
        start = at = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            free = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the forms' matches that pass their tests, in this order."""
    out = []
    if "@" in text:
        out += [(start, 0, end) for start, end in emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(p.lstrip("0").rjust(3, "0") <= "255" and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out)


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words near each entity that lie outside every span."""
    out = []
    for number, (start, kind, end) in enumerate(spans):
        entity = f"{KINDS[kind]}:{text[start:end].lower()}"
        low, high = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
        for m in TERM.finditer(text, low, high):
            cut = (m.start() == low > 0 and text[low - 1].isalpha()) or (m.end() == high < len(text) and text[high].isalpha())
            near = spans[max(0, number - CONTEXT) : number + CONTEXT]  # spans don't begin closer than one character
            if not cut and all(m.end() <= a or b <= m.start() for a, _, b in near):
                out.append((entity, m[0].lower(), m.start(), m.end()))
    return out


SCANNED = "doc_id long, spans array<struct<start:long,kind:int,end:long>>, mentions array<struct<entity:string,term:string,start:long,end:long>>"


def scan(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                spans = base_spans(text or "")
                near = mentions(text, spans) if spans else []
                rows.append((doc_id, [dict(zip(("start", "kind", "end"), s)) for s in spans], [dict(zip(("entity", "term", "start", "end"), m)) for m in near]))
            out = pd.DataFrame(rows, columns=["doc_id", "spans", "mentions"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, SCANNED)


class TermMap(dict):
    """Whether a word may be a term, by the bits of the terms' hashes; remembered for a bounded number of words."""

    def __init__(self, packed: np.ndarray) -> None:
        self.packed = packed

    def __missing__(self, word: str) -> bool:
        if len(self) > 400_000:
            self.clear()
        at = xxhash.xxh64_intdigest(word.encode(), 42) % MAP_BITS  # MAP_BITS divides 2^64: the sign doesn't matter
        hit = self[word] = bool(int(self.packed[at >> 5]) >> (at & 31) & 1)
        return hit


def term_bits(terms: DataFrame) -> np.ndarray:
    """A map of fixed size with the bits of the terms' hashes set; words whose bit is not set can't be terms."""
    bit = F.pmod(F.xxhash64("term"), F.lit(MAP_BITS))
    words = terms.select(bit.alias("bit")).select(F.expr("CAST(bit div 32 AS int)").alias("word"), F.expr("shiftleft(1L, CAST(bit % 32 AS int))").alias("bits"))
    packed = np.zeros(MAP_BITS // 32, np.uint32)
    for row in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        packed[row["word"]] = row["bits"]
    return packed


def term_documents(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, documents): in how many of all rows each of the terms occurs.

    Words of the terms' map are counted in each task, then summed.
    """
    packed = term_bits(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = TermMap(packed)
        counts: Counter[str] = Counter()

        def flushed() -> pd.DataFrame:
            out = pd.DataFrame({"term": list(counts), "documents": list(counts.values())}, columns=["term", "documents"])
            counts.clear()
            return out.astype({"documents": "int64"})

        for batch in batches:
            for text in batch["text"]:
                counts.update(word for word in {w.lower() for w in set(TERM.findall(text or ""))} if known[word])
                if len(counts) > 200_000:
                    yield flushed()
        if counts:  # a task of no terms hands on nothing
            yield flushed()

    counted = docs.select("text").mapInPandas(run, "term string, documents long").groupBy("term").agg(F.sum("documents").alias("documents"))
    return counted.join(terms, "term", "left_semi")


def occurrences(text: str, spans: list[tuple[int, int, int]], known: TermMap) -> list[tuple[str, int, int]]:
    """(term, start, end) of every word of the whole text that may be a term and lies outside every span."""
    out, starts, reach = [], [a for a, _, _ in spans], [0, *itertools.accumulate((b for *_, b in spans), max)]
    for m in TERM.finditer(text):
        if known[word := m[0].lower()] and reach[bisect_left(starts, m.end())] <= m.start():
            out.append((word, m.start(), m.end()))
    return out


MARKED = "doc_id long, spans array<struct<start:long,kind:int,end:long>>, words array<struct<term:string,start:long,end:long>>"


def marked(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, spans, words) of every row: the forms' spans and the words that may be one of the terms."""
    packed = term_bits(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = TermMap(packed)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                spans = base_spans(text or "")
                words = occurrences(text or "", spans, known)
                rows.append((doc_id, [dict(zip(("start", "kind", "end"), s)) for s in spans], [dict(zip(("term", "start", "end"), w)) for w in words]))
            out = pd.DataFrame(rows, columns=["doc_id", "spans", "words"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, MARKED)


def disclosing(scanned: DataFrame, docs: DataFrame, rows: int, threshold: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of the pairs at or over the threshold.

    An entity in n(e) of N rows has log2(N / n(e)) bits. A term in n(t) rows,
    n(t, e) of them near the entity, tells log2(n(t, e) N / (n(t) n(e))) bits of
    it; the disclosure is their quotient. All counts are of rows of the corpus.
    """
    pairs = scanned.select("uid", F.explode("mentions").alias("m")).select("uid", "m.entity", "m.term").distinct()
    together = settle(pairs.groupBy("entity", "term").agg(F.count("*").alias("together")))
    entities = scanned.select("uid", F.explode(F.array_distinct(F.transform("mentions", lambda m: m["entity"]))).alias("entity")).groupBy("entity").agg(F.count("*").alias("holders"))
    frequency = term_documents(docs, together.where(F.col("together") >= support).select("term").distinct())
    seen = together.where(F.col("together") >= support).join(entities, "entity").join(frequency, "term")
    bits = F.log2(F.lit(float(rows)) / F.col("holders"))
    told = F.log2(F.col("together") * F.lit(float(rows)) / (F.col("documents") * F.col("holders")))
    return seen.withColumn("disclosure", F.when(bits > 0, told / bits).otherwise(F.lit(0.0))).where(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def find(docs: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(doc_id, spans) of every row: the forms' spans and those of disclosing terms, by (start, kind, end).

    A term that discloses an entity is marked wherever it occurs outside the
    forms' spans, in every row, near the entity or not. Positions are code
    points of the whole text, ends exclusive; null text is taken as empty.
    Repeated rows are rows of their own, in the counts as well.
    """
    scanned = settle(scan(docs).withColumn("uid", F.monotonically_increasing_id()))
    terms = settle(disclosing(scanned, docs, scanned.count(), threshold, support).select("term").distinct())
    found = settle(marked(docs, terms).withColumn("uid", F.monotonically_increasing_id()))
    words = found.select("uid", F.explode("words").alias("w")).select("uid", "w.*")
    hits = words.join(terms, "term", "left_semi").select("uid", F.struct("start", F.lit(4).alias("kind"), "end").alias("span"))
    told = hits.groupBy("uid").agg(F.collect_list("span").alias("terms"))
    joined = found.select("uid", "doc_id", "spans").join(told, "uid", "left")
    return joined.select("doc_id", F.array_sort(F.concat("spans", F.coalesce("terms", F.array().cast("array<struct<start:long,kind:int,end:long>>")))).alias("spans"))


def sanitised(text: str | None, spans: list[tuple[int, int, int]]) -> str:
    """Personal data become their kind; a disclosing term becomes [NAME] if capitalised, and goes otherwise."""
    out, at, text = [], 0, text or ""
    for start, kind, end in spans:
        if start >= at:
            word = text[start:end]
            out += [text[at:start], GENERAL.get(KINDS[kind]) or ("[NAME]" if word[:1].isupper() else "")]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(doc_id, text) with personal data generalised; needs doc_ids that occur once."""
    clean = F.udf(lambda text, spans: sanitised(text, [tuple(s) for s in spans]), "string", useArrow=True)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(find(docs, threshold, support), "doc_id")
    return found.select("doc_id", F.when(F.size("spans") > 0, clean("text", "spans")).otherwise(F.coalesce("text", F.lit(""))).alias("text"))


def _joined(spans: str) -> str:
    names = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')"


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(spans, x -> x.kind = {i})) AS bigint)").alias(f"n_{KINDS[i]}") for i in range(4)],
        F.sha2(F.expr(_joined("filter(spans, x -> x.kind < 4)")), 256).alias("base_sha256"),
        F.expr(_joined("spans")).alias("spans"),
    )
