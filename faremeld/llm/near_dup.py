"""Near-duplicate documents by ProbMinHash signatures, banding and verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import chunks, components, discard, settle, table

#: Words of a shingle, least similarity, registers of a signature and registers of a band.
#: A pair at the least similarity shares one of the 24 bands with probability 0.9993.
SHINGLE, SIMILARITY, REGISTERS, BAND = 5, 0.8, 144, 6
#: Documents of a block, where a group is compared block by block.
BLOCK = 256

_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits each depend on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingles(texts: list[str | None], words: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document's place, shingle hash, count) for the distinct shingles of each
    text, ordered by these. Words are split at white space, in lower case. A
    text of fewer words than `size` is one shingle; without words it has none."""
    owners, keys = [], []
    for at, text in enumerate(texts):
        found = (text or "").lower().split()
        if not found:
            continue
        h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
        n = max(1, len(h) - size + 1)
        key = np.full(n, min(size, len(h)), np.uint64)
        for i in range(min(size, len(h))):
            key = key * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        owners.append(np.full(n, at, np.int64))
        keys.append(key)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner, key = np.concatenate(owners), mix(np.concatenate(keys))
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])])
    return owner[first], key[first], np.diff(np.r_[first, len(owner)])


def signatures(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, documents: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: [documents, registers] of the element that arrives first in each register.

    Every element is a Poisson process whose rate is its share of the document's
    weight. Its k-th arrival (an exponential wait and a register) depends on the
    element and k alone, so two documents agree in a register with the
    probability of their probability Jaccard. An element stops as soon as its
    next arrival comes later than the last register's first one.
    """
    total = np.bincount(owner, weights=weight, minlength=documents)
    rate = weight / total[owner] if len(owner) else np.zeros(0)
    best = np.full(documents * registers, np.inf)
    who = np.zeros(documents * registers, np.uint64)
    time, draw = np.zeros(len(owner)), mix(key ^ np.uint64(0x5851F42D4C957F2D))
    live, worst = np.arange(len(owner)), np.full(documents, np.inf)
    while len(live):
        draw[live] = d = mix(draw[live] + np.uint64(0x9E3779B97F4A7C15))
        unit = ((d >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        time[live] += -np.log(unit) / rate[live]
        live = live[time[live] < worst[owner[live]]]
        if not len(live):
            break
        slot = owner[live] * registers + (mix(draw[live] ^ _MIX[1]) % np.uint64(registers)).astype(np.int64)
        came = time[live]
        np.minimum.at(best, slot, came)
        won = came == best[slot]
        who[slot[won]] = key[live[won]]
        touched = np.unique(owner[live])
        worst[touched] = best.reshape(documents, registers)[touched].max(axis=1)
    return who.reshape(documents, registers)


def damped(count: np.ndarray) -> np.ndarray:
    """Weight of a shingle that occurs so often: repeats count, but less and less."""
    return 1 + np.log(count)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, least: float = 0.0) -> float:
    """Of two weighted sets with sorted keys: the sum over common x of 1 / sum_y max(p_y/p_x, q_y/q_x).

    0 where it is certainly below `least`.
    """
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    ia = np.flatnonzero(b[at] == a)
    ib = at[ia]
    p, q = wa / wa.sum(), wb / wb.sum()
    pc, qc = p[ia], q[ib]
    # the similarity is at most the smaller shares' sum
    if np.minimum(pc, qc).sum() < least:
        return 0.0
    # y only in one set: its share over x's; y in both: the larger of the two ratios, by sorting p_y/q_y
    ratio = pc / qc
    order = np.argsort(ratio, kind="stable")
    ps, qs = pc[order], qc[order]
    above = np.r_[np.cumsum(ps[::-1])[::-1][1:], 0.0]  # p_y/q_y beyond x's: p_y/p_x is the larger
    below = np.cumsum(qs)
    if not len(ia):
        return 0.0
    only_a, only_b = max(0.0, 1 - pc.sum()), max(0.0, 1 - qc.sum())
    return float((1 / ((above + only_a) / ps + (below + only_b) / qs)).sum())


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, content, bands) of each document with a word; `content` identifies its shingles and counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), [t or "" for t in batch["text"]]
            for part in chunks(texts):
                owner, key, count = shingles(texts[part], words)
                n = len(texts[part])
                who = signatures(owner, key, damped(count), n)
                band = np.zeros((n, REGISTERS // BAND), np.uint64)
                for i in range(BAND):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + who[:, i::BAND])
                edge = np.searchsorted(owner, np.arange(n + 1))
                rows = []
                for i in range(n):
                    if edge[i] < edge[i + 1]:
                        own = slice(edge[i], edge[i + 1])
                        content = content_of(key[own], count[own])
                        rows.append((ids[part.start + i], content, band[i].view(np.int64)))
                yield pd.DataFrame(rows, columns=["doc_id", "content", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").where("text is not null and doc_id is not null").mapInPandas(run, "doc_id long, content binary, bands array<long>")


def content_of(key: np.ndarray, count: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(key.tobytes() + count.tobytes())


def weighted_sets(texts: DataFrame) -> DataFrame:
    """(node, weighted, sketch, bands) of (node, content, text, bands) rows whose text has that content.

    Sorted shingle hashes and counts, and 32 bits of each register.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            nodes, texts = batch["node"].to_numpy(np.int64), [t or "" for t in batch["text"]]
            contents, bands = batch["content"].tolist(), batch["bands"].tolist()
            for part in chunks(texts):
                owner, key, count = shingles(texts[part], words)
                edge = np.searchsorted(owner, np.arange(len(texts[part]) + 1))
                sketch = signatures(owner, key, damped(count), len(edge) - 1).astype(np.uint32)
                rows = []
                for i, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
                    if bytes(contents[part.start + i]) == content_of(key[a:b], count[a:b]):
                        weighted = key[a:b].tobytes() + count[a:b].astype(np.int32).tobytes()
                        rows.append((nodes[part.start + i], weighted, sketch[i].tobytes(), np.asarray(bands[part.start + i], np.int64).tobytes()))
                yield pd.DataFrame(rows, columns=["node", "weighted", "sketch", "bands"]).astype({"node": "int64", "weighted": object, "sketch": object, "bands": object})

    return texts.select("node", "content", "text", "bands").mapInPandas(run, "node long, weighted binary, sketch binary, bands binary")


def _opened(weighted: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(weighted) // 12
    return np.frombuffer(weighted, np.uint64, n), damped(np.frombuffer(weighted, np.int32, n, 8 * n))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose probability Jaccard is at least `similarity`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[probability_jaccard(*_opened(x), *_opened(y), similarity - 1e-12) >= similarity - 1e-12 for x, y in zip(batch["x"], batch["y"])], ["a", "b"]]

    x = sets.select(F.col("node").alias("a"), F.col("weighted").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("weighted").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _ordered(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def cross_links(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the components of each group, of (group, node, component).

    Documents are dealt to blocks: a large component has blocks of its own,
    small ones share blocks. Blocks meet in pairs, but never two of one
    component, since what is joined needs no comparison. Of two components, a
    task reports one link. Every pair that shares a band, or agrees in as many
    registers as a pair at the similarity does on average, is verified unless
    links found before join it, those of most agreement first.
    """
    sizes = nodes.groupBy("group", "component").agg(F.count("*").alias("n")).withColumn("large", F.col("n") > BLOCK // 2)
    small = sizes.where("NOT large").groupBy("group").agg(F.ceil(F.sum("n") / BLOCK).cast("long").alias("parts"))
    own = F.when(F.col("large"), F.xxhash64("component", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK).cast("long"))))
    own = own.otherwise(F.xxhash64("group", F.lit("small"), F.pmod(F.xxhash64("component"), F.coalesce("parts", F.lit(1)))))
    dealt = settle(nodes.join(sizes, ["group", "component"]).join(small, "group", "left").select("group", "node", "component", "large", own.alias("own")))
    others = dealt.select("group", F.col("own").alias("other"), F.when(F.col("large"), F.col("component")).alias("alone")).distinct()
    met = dealt.join(others, "group").where("NOT large OR alone IS NULL OR alone <> component")
    rows = met.join(sets, "node").select("group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component", "weighted", "sketch", "bands")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        low, high = part["low"].iloc[0], part["high"].iloc[0]
        left, right = part[part["own"] == low], part[part["own"] == high]
        x, y = (np.frombuffer(b"".join(p["sketch"]), np.uint32).reshape(len(p), -1) for p in (left, right))
        bx, by = (np.frombuffer(b"".join(p["bands"]), np.int64).reshape(len(p), -1) for p in (left, right))
        cx, cy = left["component"].to_numpy(), right["component"].to_numpy()
        parent = {c: c for c in (*cx.tolist(), *cy.tolist())}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        tried, nx, ny = [], left["node"].to_numpy(), right["node"].to_numpy()
        for i in range(len(left)):
            agree = (y == x[i]).mean(axis=1)
            near = np.flatnonzero(((by == bx[i]).any(axis=1) | (agree >= similarity)) & (cy != cx[i]))
            tried += [(-agree[j], i, int(j)) for j in near if low != high or j > i]
        out, wx, wy = [], left["weighted"].tolist(), right["weighted"].tolist()
        for _, i, j in sorted(tried):
            a, b = root(int(cx[i])), root(int(cy[j]))
            if a != b and probability_jaccard(*_opened(wx[i]), *_opened(wy[j]), similarity - 1e-12) >= similarity - 1e-12:
                parent[b] = a
                out.append((min(nx[i], ny[j]), max(nx[i], ny[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.groupBy("group", "low", "high").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, component_id, kept) for every distinct doc_id of (doc_id, text).

    Documents with the same weighted shingles are one class, named by its
    smallest doc_id. Classes that share a band are candidates; those of at least
    `similarity` in exact probability Jaccard are linked, and a component is
    what links reach. One document of each component is kept, the smallest.
    Null, empty and wordless texts stand alone and stay; rows of one doc_id
    with several texts count as linked; a null doc_id is left out.

    Buckets have no cap. Each is first compared with its smallest class. Where
    members of a bucket then lie in different components, these components form
    a group, and what is not yet joined in it is compared block by block. So a
    group of thousands of near copies costs about one comparison each, and
    those that stay apart from it one with each of its members.
    """
    found = settle(features(docs))
    contents = settle(found.groupBy("content").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("class_id")).withColumn("node", F.monotonically_increasing_id()))
    owned = settle(found.select("doc_id", "content").distinct().join(contents.select("content", "class_id", "node"), "content").select("doc_id", "class_id", "node"))
    discard(found)
    several = owned.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    links = owned.join(several, "doc_id").where("node <> a").select("a", F.col("node").alias("b")).distinct()

    banded = contents.select("node", F.posexplode("bands").alias("band", "key"))
    bucket = banded.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1")
    members = settle(banded.join(bucket, ["band", "key"]).select(F.xxhash64("band", "key").alias("bucket"), "node", "leader"))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    wanted = contents.join(members.select("node").distinct(), "node", "left_semi").withColumnRenamed("class_id", "doc_id")
    sets = settle(weighted_sets(texts.join(wanted, "doc_id").dropDuplicates(["doc_id", "node", "text"])))
    tried = members.where("node <> leader").select(*_ordered(F.col("leader"), F.col("node"))).distinct()
    first = settle(links.union(verified(tried, sets, similarity)))
    label = settle(components(first))

    named = members.join(label, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket", "low")
    opened = settle(named.join(mixed, "bucket").select("node", "component", "low").distinct())
    groups = components(opened.select(F.col("low").alias("a"), F.col("component").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("group"))
    nodes = opened.select("node", "component").distinct().join(groups, "component")
    more = settle(cross_links(nodes, sets, similarity))
    label = settle(components(first.union(more)))
    discard(first, more, opened, members, sets)

    placed = owned.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    grouped = placed.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("component").alias("component"))
    named = grouped.join(least, "component").select("doc_id", "class_id", "component_id")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    out = every.join(named, "doc_id", "left")
    own = F.col("doc_id")
    return out.select("doc_id", F.coalesce("class_id", own).alias("class_id"), F.coalesce("component_id", own).alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op10_probminhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays; of rows with one doc_id, all that are equal in text do."""
    gone = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
