"""Near-duplicate vectors: a neighbour graph refined by NN-descent, audited, cut at a similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeld.llm.common import components, discard, settle, table

SIMILARITY = 0.9
#: Neighbours kept of each vector; of those over the similarity, this many times as many.
NEIGHBOURS, ENLARGE = 10, 4
#: Random trees that seed the graph, rows of a leaf, most rounds, and the share of new links that ends them.
TREES, LEAF, ROUNDS, SETTLED = 12, 48, 4, 0.002
#: Vectors whose links are counted against all rows, the recall they must show, further seedings.
AUDITED, RECALL, RESEEDINGS = 512, 0.98, 2
#: Rows of a block where a whole component is compared; rows of a task's batch of groups.
BLOCK, BATCH_ROWS = 1024, 6000
#: Single precision may be so far off; pairs so close to the similarity are computed again in double.
MARGIN = 1e-5

LINKS = "v long, w long, sim float"


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, unit): doubles of length 1 as bytes; null for vectors that can't be compared.

    A vec_id comes once: repeated rows are one vector, and of several vectors
    under one id the smallest bytes count. Null ids are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for vector in batch["embedding"]:
                x = np.array([np.nan if c is None else c for c in vector], np.float64) if vector is not None else np.zeros(0)
                scale = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                made.append((x / scale / np.linalg.norm(x / scale)).tobytes() if scale > 0 else None)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "unit": made})

    rows = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInPandas(run, "vec_id long, unit binary").groupBy("vec_id").agg(F.min("unit").alias("unit"))


def seed_groups(nodes: DataFrame, rows: int, trees: int, seed: int) -> DataFrame:
    """(g, id): in each of some random hyperplane trees, the vectors of one leaf; crowded leaves are dealt by hash."""
    bits = max(1, int(np.ceil(np.log2(max(2, rows / LEAF)))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch["unit"].map(len)
            for size, part in batch.groupby(sizes):
                dims = size // 8
                if dims not in planes:
                    planes[dims] = np.random.default_rng([seed, dims]).standard_normal((dims, trees * bits))
                x = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(-1, dims)
                signs = (x @ planes[dims] > 0).reshape(len(x), trees, bits)
                codes = signs @ (1 << np.arange(bits))
                ids = part["id"].to_numpy()
                yield pd.DataFrame({"id": np.repeat(ids, trees), "tree": np.tile(np.arange(trees), len(ids)), "dims": dims, "code": codes.ravel()})

    coded = settle(nodes.select("id", "unit").mapInPandas(run, "id long, tree int, dims int, code long"))
    leaf = ["tree", "dims", "code"]
    sizes = coded.groupBy(*leaf).agg(F.count("*").alias("n")).where("n > 1")
    dealt = F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / (2 * LEAF)).cast("long"))
    return coded.join(sizes, leaf).select(F.xxhash64(*leaf, dealt, F.lit(seed)).alias("g"), "id", F.lit(True).alias("fresh"))


def around(graph: DataFrame) -> DataFrame:
    """(g, id, fresh): each vector with its neighbours and with those that it is a neighbour of.

    Where very many have one vector as neighbour, they are dealt to several
    groups, and its own neighbours go to all of these.
    """
    ahead = graph.select(F.col("v").alias("hub"), F.col("w").alias("id"), "fresh")
    back = graph.select(F.col("w").alias("hub"), F.col("v").alias("id"), "fresh")
    crowd = back.groupBy("hub").agg(F.count("*").alias("n")).select("hub", F.ceil(F.col("n") / LEAF).cast("int").alias("parts"))
    dealt = back.join(crowd, "hub").select("hub", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int").alias("part"), "id", "fresh")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    own = ahead.union(graph.select("v", "v", F.lit(False)).distinct()).join(crowd, "hub", "left").select("hub", parts, "id", "fresh")
    return own.union(dealt).groupBy(F.xxhash64("hub", "part").alias("g"), "id").agg(F.max("fresh").alias("fresh"))


def compared(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """The best pairs (v, w, sim) within each group of which one is fresh, both ways."""
    total = groups.count()
    bins = max(1, -(-total // BATCH_ROWS))
    keep = NEIGHBOURS * ENLARGE

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("g", kind="stable")
        g, ids, fresh = batch["g"].to_numpy(), batch["id"].to_numpy(), batch["fresh"].to_numpy(bool)
        edges = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True])
        units = batch["unit"].tolist()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, z in zip(edges[:-1], edges[1:]):
            if z - a < 2 or not fresh[a:z].any():
                continue
            x = np.frombuffer(b"".join(units[a:z]), np.float32).reshape(z - a, -1)
            sims = x @ x.T
            sims[~(fresh[a:z, None] | fresh[None, a:z])] = -2
            np.fill_diagonal(sims, -2)
            near = np.argsort(-sims, axis=1)[:, : min(keep, z - a - 1)]
            rows = np.repeat(np.arange(z - a), near.shape[1])
            s = sims[rows, near.ravel()]
            # few below the similarity are enough to find the way
            good = (s > -2) & ((s >= SIMILARITY - MARGIN) | (np.tile(np.arange(near.shape[1]), z - a) < NEIGHBOURS))
            out.append((ids[a:z][rows][good], ids[a:z][near.ravel()][good], s[good]))
        if not out:
            return pd.DataFrame({"v": [], "w": [], "sim": []}).astype({"v": "int64", "w": "int64", "sim": "float32"})
        v, w, s = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((w, -s, v))
        v, w, s = v[order], w[order], s[order]
        new = np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])]
        v, w, s = v[new], w[new], s[new]
        rank = np.arange(len(v)) - np.maximum.accumulate(np.where(np.r_[True, v[1:] != v[:-1]], np.arange(len(v)), 0))
        best = (rank < NEIGHBOURS) | ((s >= SIMILARITY - MARGIN) & (rank < keep))
        return pd.DataFrame({"v": v[best], "w": w[best], "sim": s[best]})

    single = F.udf(lambda unit: np.frombuffer(unit, np.float64).astype(np.float32).tobytes(), "binary", useArrow=True)
    narrow = nodes.select("id", single("unit").alias("unit"))
    rows = groups.join(narrow, "id").withColumn("bin", F.pmod(F.xxhash64("g"), F.lit(bins)))
    return rows.groupBy("bin").applyInPandas(run, LINKS)


def merged(found: DataFrame, graph: DataFrame | None) -> DataFrame:
    """The lists after a round. A list that is full of links grows to ENLARGE times its length."""
    rows = found.withColumn("fresh", F.lit(True))
    if graph is not None:
        rows = rows.unionByName(graph.select("v", "w", "sim", F.lit(False).alias("fresh")))
    once = rows.groupBy("v", "w").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("v").orderBy(F.desc("sim"), "w")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEIGHBOURS * ENLARGE)
    return settle(ranked.where((F.col("rank") <= NEIGHBOURS) | (F.col("sim") >= SIMILARITY - MARGIN)).drop("rank"))


def descend(nodes: DataFrame, rows: int, graph: DataFrame | None, seed: int) -> DataFrame:
    """Seeds the lists, then compares neighbours of neighbours until hardly any new link appears."""
    graph, old = merged(compared(settle(seed_groups(nodes, rows, TREES, seed)), nodes), graph), graph
    if old is not None:
        discard(old)
    for _ in range(ROUNDS):
        graph, old = merged(compared(settle(around(graph)), nodes), graph), graph
        discard(old)
        links = graph.where(F.col("sim") >= SIMILARITY).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("fresh").cast("long")), F.lit(0)).alias("new")).first()
        if links["new"] <= SETTLED * links["n"]:
            break
    return graph


def exact_links(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b), a < b, of at least the similarity in double precision."""
    pairs = graph.where(F.col("sim") >= SIMILARITY - MARGIN).select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b"), "sim")
    pairs = settle(pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")))
    sure = pairs.where(F.col("sim") >= SIMILARITY + MARGIN).select("a", "b")
    close = pairs.where(F.col("sim") < SIMILARITY + MARGIN).select("a", "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) >= SIMILARITY for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[good, ["a", "b"]]

    x, y = (nodes.select(F.col("id").alias(i), F.col("unit").alias(u)) for i, u in (("a", "x"), ("b", "y")))
    return settle(sure.union(close.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")))


def blocks(open_nodes: DataFrame) -> DataFrame:
    """(component, id, unit, copies, block): blocks of about BLOCK rows, each of one component."""
    sizes = open_nodes.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    own = F.xxhash64("component", F.pmod(F.xxhash64("id"), F.col("blocks")))
    return settle(open_nodes.join(sizes, "component").select("component", "id", "unit", "copies", own.alias("block")))


def touching(dealt: DataFrame) -> DataFrame:
    """(x, y): the pairs of blocks that may hold a link, each once, a block with itself too.

    A block lies in a ball of angles around its mean. By the triangle inequality
    no vectors of two balls are linked if their centres' angle exceeds both
    radii and the angle of the similarity.
    """

    def ball(part: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(len(part), -1)
        centre = x.mean(axis=0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > 1e-6 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pd.DataFrame({"block": part["block"].iloc[:1], "dims": x.shape[1], "centre": [centre.tobytes()], "radius": radius})

    balls = settle(dealt.groupBy("block").applyInPandas(ball, "block long, dims int, centre binary, radius double"))
    parts = max(1, -(-balls.count() // BLOCK))
    own = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    keyed = balls.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        low, high = part["low"].iloc[0], part["high"].iloc[0]
        left, right = part[part["own"] == low], part[part["own"] == high]
        if not len(left) or not len(right):
            return pd.DataFrame({"x": [], "y": []}).astype("int64")
        x, y = (np.frombuffer(b"".join(p["centre"]), np.float64).reshape(len(p), -1) for p in (left, right))
        apart = np.arccos(np.clip(x @ y.T, -1, 1)) - left["radius"].to_numpy()[:, None] - right["radius"].to_numpy()[None, :]
        near = apart <= np.arccos(SIMILARITY) + 1e-6
        i, j = np.nonzero(np.triu(near) if low == high else near)
        return pd.DataFrame({"x": left["block"].to_numpy()[i], "y": right["block"].to_numpy()[j]})

    return settle(keyed.groupBy("dims", "low", "high").applyInPandas(run, "x long, y long"))


def block_links(open_nodes: DataFrame) -> DataFrame:
    """(id, n, other) for (component, id, unit, copies): summed by id, n is the copies of all others linked to it.

    Blocks are compared within and across components. Of two components' blocks
    with a link, one row names a link (id, other) and counts nothing.
    """
    dealt = blocks(open_nodes)
    pairs = touching(dealt).withColumn("block", F.explode(F.array_distinct(F.array("x", "y"))))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        low, high = part["x"].iloc[0], part["y"].iloc[0]
        left, right = part[part["block"] == low], part[part["block"] == high]
        x, y = (np.frombuffer(b"".join(p["unit"]), np.float64).reshape(len(p), -1) for p in (left, right))
        linked = x @ y.T >= SIMILARITY
        if low == high:
            np.fill_diagonal(linked, False)
            return pd.DataFrame({"id": left["id"], "n": linked @ right["copies"].to_numpy(), "other": pd.array([None] * len(left), "Int64")})
        ids, n = np.r_[left["id"], right["id"]], np.r_[linked @ right["copies"].to_numpy(), linked.T @ left["copies"].to_numpy()]
        out = pd.DataFrame({"id": ids, "n": n, "other": pd.array([None] * len(ids), "Int64")})[n > 0]
        if len(out) and left["component"].iloc[0] != right["component"].iloc[0]:
            i, j = np.unravel_index(linked.argmax(), linked.shape)
            out = pd.concat([out, pd.DataFrame({"id": left["id"].iloc[[i]], "n": 0, "other": pd.array([right["id"].iloc[j]], "Int64")})])
        return out

    return settle(pairs.join(dealt, "block").groupBy("x", "y").applyInPandas(run, "id long, n long, other long"))


def counted(nodes: DataFrame, graph: DataFrame, every: bool = False) -> DataFrame:
    """(id, n_links, component) of every node.

    Links are those in the lists. A list that is still full of links at its
    greatest length may miss some, to vectors of its own component or, if their
    lists are full as well, of another. So all components with such a list (or
    `every` one) are compared block by block, each with itself and with those
    that it may touch, and only counts and one link a pair leave the blocks.
    """
    links = exact_links(graph, nodes)
    label = settle(components(links))
    if every:
        open_label = nodes.select("id").join(label.withColumnRenamed("node", "id"), "id", "left").select(F.coalesce("component", "id").alias("component"), "id")
    else:
        full = graph.where(F.col("sim") >= SIMILARITY - MARGIN).groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") >= NEIGHBOURS * ENLARGE)
        crowded = full.join(label, full["v"] == label["node"]).select("component").distinct()
        open_label = label.join(crowded, "component").select("component", F.col("node").alias("id"))
    open_label = settle(open_label)
    compared_rows = block_links(open_label.join(nodes, "id").select("component", "id", "unit", "copies"))
    bridges = compared_rows.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
    if not bridges.isEmpty():
        label = settle(components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).union(bridges)))
    many = compared_rows.groupBy("id").agg(F.sum("n").alias("n"))
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select("b", "a"))
    few = both.join(open_label.select("id"), "id", "left_anti").join(nodes.select(F.col("id").alias("other"), "copies"), "other").groupBy("id").agg(F.sum("copies").alias("n"))
    counts = nodes.select("id", "copies").join(many.union(few), "id", "left").join(label.withColumnRenamed("node", "id"), "id", "left")
    return settle(counts.select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")))


def audit(nodes: DataFrame, found: DataFrame, size: int = AUDITED) -> float:
    """Recall of the links of a fixed number of vectors, those of the least hashes, each compared with all rows."""
    asked = nodes.select("id", "unit").orderBy(F.xxhash64("id"), "id").limit(size).collect()
    by_dims: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims in {len(r["unit"]) for r in asked}:
        own = [r for r in asked if len(r["unit"]) == dims]
        by_dims[dims] = np.array([r["id"] for r in own]), np.frombuffer(b"".join(bytes(r["unit"]) for r in own), np.float64).reshape(len(own), -1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part in batch.groupby(batch["unit"].map(len)):
                if dims in by_dims:
                    ids, x = by_dims[dims]
                    linked = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(len(part), -1) @ x.T >= SIMILARITY
                    linked &= part["id"].to_numpy()[:, None] != ids[None, :]
                    yield pd.DataFrame({"id": ids, "n": part["copies"].to_numpy() @ linked})

    true = nodes.select("id", "unit", "copies").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    own = nodes.select("id", (F.col("copies") - 1).alias("same"))
    rows = true.join(found, "id").join(own, "id").agg(F.sum("n").alias("n"), F.sum(F.least(F.col("n_links") - F.col("same"), F.col("n"))).alias("hit")).first()
    return 1.0 if not rows["n"] else rows["hit"] / rows["n"]


def near_duplicate_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every vec_id of (vec_id, embedding).

    Vectors of one direction are one node with a number of copies. Vectors that
    are null, empty or zero, or hold null or non-finite components, and vectors
    of other lengths, link with nothing. `recall` is what the audit measured;
    below RECALL the graph is seeded anew, RESEEDINGS times at most, and then
    every vector is compared block by block. An empty table gives an empty one.
    """
    points = settle(unit_vectors(embeddings))
    nodes = settle(points.where("unit IS NOT NULL").groupBy("unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    rows = nodes.count()
    graph, recall, found = None, 1.0, nodes.select("id", (F.col("copies") - 1).alias("n_links"), F.col("id").alias("component"))
    for turn in range(1 + RESEEDINGS) if rows > 1 else ():
        graph = descend(nodes, rows, graph, turn)
        found = counted(nodes, graph)
        recall = audit(nodes, found)
        if recall >= RECALL:
            break
    else:
        if rows > 1:
            found = counted(nodes, graph, every=True)
            recall = audit(nodes, found)
    if recall < RECALL:
        raise RuntimeError(f"only {recall:.3f} of the audited vectors' links were found")
    member = points.join(nodes.select("unit", "id"), "unit", "left").select("vec_id", "id")
    out = member.join(found, "id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"), F.lit(float(recall)).alias("recall"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
