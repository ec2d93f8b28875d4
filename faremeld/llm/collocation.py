"""Phrase collocations: counts of phrases from suffix subtrees built per group of word prefixes."""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremeld.llm.common import discard, settle, table

#: Least count of a phrase, share of a phrase's occurrences that a longer one must have to replace it, rows returned a language.
LEAST, COVERED, TOP = 10, 50, 2000
#: Groups of prefixes to begin with, and the occurrences that one may hold: with more text first groups grow, then their number.
GROUPS, BUDGET = 1 << 9, 1 << 22
#: Bits of the fixed map that tells which words are frequent; words outside it begin and continue no phrase.
MAP_BITS = 1 << 24
#: Distinct words and suffixes that a task holds before it hands them on.
HELD_WORDS, HELD_SUFFIXES = 150_000, 1_000_000
#: Shares in which a language's phrases are ranked at first.
SHARES = 128
#: Words that a task numbers and counts together.
STRETCH = 100_000

#: Lower case for A-Z, one byte that no UTF-8 text holds for each mark that ends a piece, blanks for tabs.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))
_END = b"\xff"


def words_of(text: str) -> list[bytes]:
    """The words of a text, lower case, with `_END` where a piece ends."""
    return text.encode().translate(_BYTES).replace(_END, b" \xff ").split()


class Numbers(dict):
    """Numbers the words of one language as they come, 0 outside the map; the task's `held` keeps each number's hash."""

    def __init__(self, lang: str, held: Held) -> None:
        super().__init__()
        self.start, self.held = lang.encode() + b"\0", held
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        held = self.held
        h = xxhash.xxh64_intdigest(self.start + word, held.seed) or 1
        if held.packed is not None and not int(held.packed[h % MAP_BITS >> 5]) >> (h & 31) & 1:
            return 0  # rare, so not worth the memory
        self[word] = number = len(held.hashes)
        held.hashes.append(h)
        held.wanted.append(h in held.first)
        return number


class Held:
    """The words that a task has numbered, until it hands its counts on; `wanted` tells those of `first`."""

    def __init__(self, seed: int, packed: np.ndarray | None, first: np.ndarray | None = None) -> None:
        self.seed, self.packed = seed, packed
        self.first = frozenset(() if first is None else first.view(np.uint64).tolist())
        self.clear()

    def clear(self) -> None:
        self.langs: dict[str, Numbers] = {}
        self.hashes, self.wanted = array("Q", [0]), bytearray(1)

    def full(self) -> bool:
        return sum(map(len, self.langs.values())) > HELD_WORDS

    def named(self) -> np.ndarray:
        return np.array(self.hashes, np.uint64).view(np.int64)

    def only_wanted(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(np.frombuffer(self.wanted, np.bool_)[numbers], numbers, 0)

    def numbered(self, batch: pd.DataFrame) -> Iterator[np.ndarray]:
        """The numbers of the batch's words in pieces of STRETCH, each with the two that follow; 0 ends a text's piece."""
        for lang, part in batch.groupby("lang"):
            waiting: list[bytes] = []
            for text in [*part["text"], None]:
                if text is not None:
                    waiting += words_of(text)
                    waiting.append(_END)
                while len(waiting) > STRETCH or text is None and waiting:
                    now = waiting[: STRETCH + 2]
                    numbers = self.langs.get(lang)
                    if numbers is None:
                        numbers = self.langs[lang] = Numbers(lang, self)
                    found = np.zeros(min(len(waiting), STRETCH) + 2, np.int64)
                    found[: len(now)] = np.fromiter(map(numbers.__getitem__, now), np.int64, len(now))
                    del waiting[:STRETCH]
                    yield found


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, n): how often each word of each language occurs, counted in each task and then summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = Held(seed, None), np.zeros(1, np.int64)

        def flushed() -> Iterator[pd.DataFrame]:
            named = held.named()
            for lang, numbers in held.langs.items():
                words = ((lang, word.decode(), int(named[i]), int(total[i])) for word, i in numbers.items() if i and i < len(total) and total[i])
                while out := list(itertools.islice(words, 20_000)):
                    yield pd.DataFrame(out, columns=["lang", "word", "h", "n"])
            held.clear()

        for batch in batches:
            for x in held.numbered(batch):
                n = np.bincount(x[:-2], minlength=len(total))
                n[: len(total)] += total
                total = n
                if held.full():
                    yield from flushed()
                    total = np.zeros(1, np.int64)
        yield from flushed()

    found = _texts(docs).mapInPandas(run, "lang string, word string, h long, n long")
    return found.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def frequent_map(words: DataFrame, least: int) -> np.ndarray:
    """A map of fixed size with the bits of the frequent words' hashes set."""
    bit = F.pmod(F.col("h"), F.lit(MAP_BITS))
    rows = words.where(F.col("n") >= least).select(bit.alias("bit")).select(F.expr("CAST(bit div 32 AS int)").alias("at"), F.expr("shiftleft(1L, CAST(bit % 32 AS int))").alias("bits"))
    packed = np.zeros(MAP_BITS // 32, np.uint32)
    for row in rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        packed[row["at"]] = row["bits"]
    return packed


def _distinct(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[start], np.add.reduceat(n[order], start)


def suffixes(docs: DataFrame, seed: int, packed: np.ndarray, first: np.ndarray | None = None, groups: Groups | None = None) -> DataFrame:
    """(h1, h2, h3, n, group): the suffixes of all pieces, cut after three words, counted in each task.

    A word outside the map ends the suffix before it (as 0) and begins none: a
    phrase that holds it is too rare. With `first`, only suffixes of these
    first words, cut after two. `group` is the suffix's one of `groups`, else 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Held(seed, packed, first)
        keys, counts, size = [], [], 0

        def flushed() -> Iterator[pd.DataFrame]:
            if keys:
                h, (key, n) = held.named(), _distinct(np.concatenate(keys), np.concatenate(counts))
                for at in range(0, len(key), 100_000):
                    k = key[at : at + 100_000]
                    named = h[k >> 42], h[k >> 21 & 0x1FFFFF], h[k & 0x1FFFFF]
                    group = groups.of(*named) if groups else np.zeros(len(k), np.int64)
                    yield pd.DataFrame({"h1": named[0], "h2": named[1], "h3": named[2], "n": n[at : at + 100_000], "group": group})
            held.clear()
            keys.clear()
            counts.clear()

        for batch in batches:
            for x in held.numbered(batch):
                a, b, c = x[:-2], x[1:-1], x[2:]
                if first is None:
                    c = np.where(b == 0, 0, c)
                else:
                    a, c = held.only_wanted(a), np.zeros_like(c)
                key, n = np.unique((a << 42 | b << 21 | c)[a > 0], return_counts=True)  # three numbers of 21 bits
                if len(key):
                    keys.append(key)
                    counts.append(n)
                    size += len(key)
                if size > HELD_SUFFIXES:
                    key, n = _distinct(np.concatenate(keys), np.concatenate(counts))
                    keys[:], counts[:], size = [key], [n], len(key)
                if size > HELD_SUFFIXES // 2 and len(keys) == 1 or held.full():
                    yield from flushed()
                    size = 0
        yield from flushed()

    return _texts(docs).mapInPandas(run, "h1 long, h2 long, h3 long, n long, group long")


# ---- groups of prefixes


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for a prefix of two words; it deals prefixes to groups and never names one."""
    x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def group_starts(prefixes: DataFrame, budget: int) -> np.ndarray:
    """Where groups begin, of prefixes (p, n) in the order of p: each group holds at most twice the budget.

    Range partitions are cut into groups on their own; the driver gets one
    number a group, so at most the occurrences over the budget and the partitions.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, group = 0, -1
        for batch in batches:
            at = (before + np.cumsum(batch["n"].to_numpy()) - batch["n"].to_numpy()) // budget
            new = np.flatnonzero(np.diff(np.r_[group, at]) > 0)
            before, group = before + int(batch["n"].sum()), int(at[-1]) if len(at) else group
            yield pd.DataFrame({"p": batch["p"].to_numpy()[new]})

    found = prefixes.repartitionByRange("p").sortWithinPartitions("p").mapInPandas(run, "p long")
    return np.sort(np.fromiter((r["p"] for r in found.toLocalIterator()), np.int64))


class Groups:
    """Vertical partitions: to which group each suffix goes, by the shortest of its prefixes that fits the budget.

    Words over the budget are extended to prefixes of two words, and those to
    whole suffixes of three. The lists of prefixes over the budget are no longer
    than the occurrences over the budget.
    """

    def __init__(self, docs: DataFrame, words: DataFrame, seed: int, packed: np.ndarray, least: int, budget: int) -> None:
        common = words.where(F.col("n") >= least)
        self.heavy = np.sort(np.array([r["h"] for r in common.where(F.col("n") > budget).select("h").toLocalIterator()], np.int64))
        self.starts = group_starts(common.where(F.col("n") <= budget).select(F.col("h").alias("p"), "n"), budget)
        self.pair_starts = self.heavier = self.parts = np.zeros(0, np.int64)
        if len(self.heavy):
            pairs = settle(suffixes(docs, seed, packed, self.heavy).groupBy("h1", "h2").agg(F.sum("n").alias("n")).mapInPandas(_as_prefixes, "p long, n long"))
            over = sorted((r["p"], -(-r["n"] // budget)) for r in pairs.where(F.col("n") > budget).groupBy("p").agg(F.sum("n").alias("n")).toLocalIterator())
            self.heavier, self.parts = (np.array([x[i] for x in over], np.int64) for i in (0, 1))
            self.pair_starts = group_starts(pairs.where(F.col("n") <= budget), budget)
            discard(pairs)
        self.firsts = np.r_[0, np.cumsum(self.parts)] + len(self.starts) + len(self.pair_starts) + 2

    def of(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> np.ndarray:
        group = np.searchsorted(self.starts, h1, "right")
        if len(self.heavy):
            long = np.flatnonzero(_within(self.heavy, h1))
            p = joined_hash(h1[long], h2[long])
            group[long] = len(self.starts) + 1 + np.searchsorted(self.pair_starts, p, "right")
            if len(self.heavier):
                longer = np.flatnonzero(_within(self.heavier, p))
                at = np.searchsorted(self.heavier, p[longer])
                share = joined_hash(p[longer], h3[long[longer]]).view(np.uint64) % self.parts[at].astype(np.uint64)
                group[long[longer]] = self.firsts[at] + share.astype(np.int64)
        return group

    def split(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether a prefix of two words lies in several groups."""
        return _within(self.heavier, joined_hash(h1, h2))


def _as_prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"p": joined_hash(batch["h1"].to_numpy(), batch["h2"].to_numpy()), "n": batch["n"]})


def _within(values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(x), bool)
    return values[np.minimum(np.searchsorted(values, x), len(values) - 1)] == x


def subtrees(dealt: DataFrame, groups: Groups, least: int) -> DataFrame:
    """(h1, h2, h3, n) of the nodes of two and three words, from (group, h1, h2, h3, n); h3 is 0 for two words.

    Each group's suffixes, sorted, are its subtree: equal ones are a leaf, and a
    node's count is the total of the leaves below it, a run of the sorted list.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        h1, h2, h3, n = (part[c].to_numpy() for c in ("h1", "h2", "h3", "n"))
        order = np.lexsort((h3, h2, h1))
        h1, h2, h3, n = h1[order], h2[order], h3[order], n[order]
        pair = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        leaf = np.flatnonzero(pair | np.r_[True, h3[1:] != h3[:-1]])
        node = np.flatnonzero(pair)
        two, three = np.add.reduceat(n, node), np.add.reduceat(n, leaf)
        node, two = (x[(h2[node] != 0) & ((two >= least) | groups.split(h1[node], h2[node]))] for x in (node, two))
        leaf, three = (x[(h3[leaf] != 0) & (three >= least)] for x in (leaf, three))
        both = np.r_[node, leaf]
        return pd.DataFrame({"h1": h1[both], "h2": h2[both], "h3": np.r_[np.zeros(len(node), np.int64), h3[leaf]], "n": np.r_[two, three]})

    found = dealt.groupBy("group").applyInPandas(run, "h1 long, h2 long, h3 long, n long")
    return found.groupBy("h1", "h2", "h3").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def phrase_counts(docs: DataFrame, least: int = LEAST, budget: int = BUDGET, groups: int = GROUPS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (lang, word, h, n) of all words, and (h1, h2, h3, n) of the phrases of two and three words with n >= `least`.

    Hashes name words in between. A seed under which a frequent word shares its
    hash with any other word is given up for the next, so counts are exact.
    """
    for seed in range(8):
        words = settle(word_counts(docs, seed))
        if words.groupBy("h").agg(F.count("*").alias("words"), F.max("n").alias("n")).where((F.col("words") > 1) & (F.col("n") >= least)).isEmpty():
            break
        discard(words)
    else:
        raise RuntimeError("no seed keeps the frequent words' hashes apart")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    packed = frequent_map(words, least)
    parts = Groups(docs, words, seed, packed, least, max(1, min(budget, total // groups)))
    return words, settle(subtrees(suffixes(docs, seed, packed, groups=parts), parts, least))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP, budget: int = BUDGET, groups: int = GROUPS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of two and three words that hold together most, by language.

    A phrase is as strong as its weakest cut: a * a / (l * r) in millionths, in
    whole numbers of up to 38 digits. A phrase of two words goes if a phrase of
    three that holds it has at least `covered` hundredths of its occurrences.
    Null text is empty, null lang is `und`; doc_id and other columns are not
    read, so repeated rows count each time. No text, no rows.
    """
    words, phrases = phrase_counts(docs, least, budget, groups)
    named = words.where(F.col("n") >= least)
    single = [named.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"n{i}"), *(["lang"] if i == 1 else [])) for i in (1, 2, 3)]
    both = phrases.where("h3 = 0").drop("h3")
    longer = phrases.where("h3 <> 0")
    left, right = (both.select(F.col("h1").alias(a), F.col("h2").alias(b), F.col("n").alias(c)) for a, b, c in (("h1", "h2", "n12"), ("h2", "h3", "n23")))
    three = longer.join(left, ["h1", "h2"]).join(right, ["h2", "h3"])
    for x, key in zip(single, ("h1", "h2", "h3")):
        three = three.join(x, key)
    over = longer.select(F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("x"), "n").groupBy("x.h1", "x.h2").agg(F.max("n").alias("over"))
    two = both.join(over, ["h1", "h2"], "left").where(F.expr(f"over IS NULL OR 100 * over < {covered} * n")).join(single[0], "h1").join(single[1], "h2")
    score = "CAST(1000000 AS decimal(7,0)) * CAST(CAST(n AS decimal(15,0)) * CAST(n AS decimal(15,0)) AS decimal(31,0)) div (CAST({0} AS decimal(19,0)) * CAST({1} AS decimal(19,0)))"
    one_cut = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"), F.expr(score.format("n1", "n2")).alias("score"))
    first, second = F.expr(score.format("n1", "n23")), F.expr(score.format("n12", "n3"))
    two_cuts = three.withColumn("first", first).withColumn("second", second).withColumn("early", F.expr("first <= second"))
    two_cuts = two_cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), F.expr("IF(early, n1, n12)").alias("l"), F.expr("IF(early, n23, n3)").alias("r"), F.least("first", "second").alias("score"))
    # A language's phrases are first ranked in SHARES, so that what one task ranks in the end has a bound.
    order = F.desc("score"), F.desc("a"), "phrase"
    shared = one_cut.union(two_cuts).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    shared = shared.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = shared.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    every = words.groupBy("lang").agg(F.sum("n").alias("words")).select(F.col("lang").alias("of"), "words")
    out = ranked.join(every, F.col("lang") == F.col("of"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def oracle() -> str:
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists
), counts AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*)::BIGINT AS f
    FROM places, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {LEAST}
), held AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, f FROM candidates WHERE k = 3
), kept AS (
    SELECT c.* FROM candidates c
    LEFT JOIN (SELECT lang, phrase, max(f) AS over FROM held GROUP BY ALL) h ON c.k = 2 AND c.lang = h.lang AND c.phrase = h.phrase
    WHERE h.over IS NULL OR 100 * h.over < {COVERED} * c.f
), cuts AS (
    SELECT lang, phrase, f, unnest(range(1, k)) AS cut, w, k FROM kept
), scored AS (
    SELECT c.lang, c.phrase, c.cut, c.f AS a, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(f)::BIGINT FROM counts n WHERE n.k = 1 AND n.lang = ranked.lang) AS n, score
FROM ranked WHERE rank <= {TOP}
"""
