"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Equal vectors are one node. The nodes of a label are dealt into shards of bounded size, and each shard becomes a graph
of nested layers. Every node of the label queries every shard: down the layers with a narrow beam, then a wide beam on
the lowest layer, from which all neighbours within the threshold are followed. The beam of a shard is widened until an
audit against brute force passes. Cosines are verified in double precision, and links are joined to components.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rowsmith.llm.components import components
from rowsmith.session import materialise

THRESHOLD = 0.93
SHARD_ROWS = 20_000  # nodes of a shard: what one task holds
BLOCK_ROWS = 2_000  # nodes that query a shard in one step
CHUNK = 5  # blocks that visit a shard in one group
DEGREE = 16
BEAM = 48
AUDIT = 128  # nodes of a shard whose links are held against brute force
RECALL = 0.99
BATCH = 128


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, largest first."""
    if sims.shape[1] > k:
        part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        return np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable"), 1)
    return np.argsort(-sims, axis=1, kind="stable")


def diverse(x: np.ndarray, base: np.ndarray, cand: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours for many nodes: nearest first, each only if it is nearer to the node than to those taken before;
    free places go to the nearest left over. ``cand`` is padded with -1."""
    sims = np.einsum("bd,bcd->bc", base, x[cand])
    sims[cand < 0] = -3.0
    order = _top(sims, cand.shape[1])
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    near = x[cand]
    among = np.matmul(near, near.transpose(0, 2, 1))
    taken = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        closest = np.where(taken[:, :j], among[:, j, :j], -3.0).max(axis=1, initial=-3.0)
        taken[:, j] = (cand[:, j] >= 0) & (sims[:, j] > closest) & (taken.sum(axis=1) < degree)
    rank = np.where(taken, 0, np.where(cand >= 0, 1, 2)) * cand.shape[1] + np.arange(cand.shape[1])
    pick = np.argsort(rank, axis=1)[:, :degree]
    out = np.take_along_axis(cand, pick, 1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int):
    """Beam search of many queries at once from their ``entry`` nodes. Returns (nodes, sims, all seen sims by node)."""
    q, here = len(queries), np.arange(len(queries))[:, None]
    seen = np.full((q, len(links)), -2.0, np.float32)
    sims = np.einsum("qd,qed->qe", queries, x[entry])
    np.put_along_axis(seen, entry, sims, 1)
    order = _top(sims, beam)
    nodes, sims = np.take_along_axis(entry, order, 1), np.take_along_axis(sims, order, 1)
    for i in range(1, nodes.shape[1]):  # repeated entries count once
        sims[:, i][(nodes[:, :i] == nodes[:, i : i + 1]).any(axis=1)] = -2.0
    open_ = sims > -2.0
    wide = 4
    while open_.any():
        best = np.where(open_, sims, -3.0)
        pick = _top(best, min(wide, best.shape[1]))
        chosen = np.take_along_axis(open_, pick, 1)
        np.put_along_axis(open_, pick, False, 1)
        new = np.where(chosen[:, :, None], links[np.take_along_axis(nodes, pick, 1)], -1).reshape(q, -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        fresh = (new >= 0) & (seen[here, np.maximum(new, 0)] == -2.0)
        row, col = np.nonzero(fresh)
        if not len(row):
            continue
        node = new[row, col]
        s = np.einsum("id,id->i", queries[row], x[node]).astype(np.float32)
        seen[row, node] = s
        value = np.full(new.shape, -2.0, np.float32)
        value[row, col] = s
        all_nodes, all_sims = np.concatenate([nodes, np.maximum(new, 0)], 1), np.concatenate([sims, value], 1)
        all_open = np.concatenate([open_, fresh], 1)
        order = _top(all_sims, beam)
        nodes, sims, open_ = (np.take_along_axis(a, order, 1) for a in (all_nodes, all_sims, all_open))
        open_ &= sims > -2.0
    return nodes, sims, seen


class Graph:
    """Layers over unit vectors ``x``; nodes stand in the order of their highest layer, so layer l is the first
    ``size[l]`` nodes."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray], beam: int):
        self.x, self.links, self.beam = x, links, beam

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 3) -> tuple[Graph, np.ndarray]:
        """The graph and the order in which its nodes take the rows of ``x``."""
        n = len(x)
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(1.0 - rng.random(n)) / np.log(DEGREE)).astype(int)
        order = np.argsort(-level, kind="stable")
        x, level = np.ascontiguousarray(x[order], np.float32), level[order]
        graph = cls(x, [], BEAM)
        for layer in range(int(level.max()), -1, -1):
            size = int((level >= layer).sum())
            graph.links.insert(0, graph._layer(size))
        return graph, order

    def _layer(self, size: int) -> np.ndarray:
        """Adds the nodes of a layer in batches: each batch searches the layer so far, then links both ways."""
        degree = 2 * DEGREE
        links = np.full((size, degree), -1, np.int32)
        done = 0
        while done < size:
            new = np.arange(done, min(size, done + max(64, min(done // 2, 512))))
            base = self.x[new]
            own = np.matmul(base, base.T)
            np.fill_diagonal(own, -3.0)
            cand = new[_top(own, min(BEAM, len(new)))]
            cand[np.take_along_axis(own, cand - done, 1) == -3.0] = -1
            if done:
                found, sims, _ = beam_search(self.x, links[:done], base, self._entry(base, done), BEAM)
                found = np.where(sims > -2.0, found, -1)
                cand = np.concatenate([cand, found], 1)
            links[new] = -1
            chosen = diverse(self.x, base, cand, DEGREE)
            links[new, : chosen.shape[1]] = chosen
            # The way back: nodes with too many neighbours choose among them again.
            at, col = np.nonzero(chosen >= 0)
            target, source = chosen[at, col], new[at]
            by = np.argsort(target, kind="stable")
            target, source = target[by], source[by]
            nodes, first, count = np.unique(target, return_index=True, return_counts=True)
            both = np.full((len(nodes), degree + int(count.max(initial=0))), -1, np.int64)
            both[:, :degree] = links[nodes]
            place = np.arange(len(target)) - np.repeat(first, count)
            both[np.repeat(np.arange(len(nodes)), count), degree + place] = source
            both = -np.sort(-both, axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            both = -np.sort(-both, axis=1)
            over = (both >= 0).sum(axis=1) > degree
            links[nodes[~over]] = both[~over, :degree]
            full = np.flatnonzero(over)
            for i in range(0, len(full), 512):
                part = full[i : i + 512]
                links[nodes[part]] = diverse(self.x, self.x[nodes[part]], both[part], degree)
            done = int(new[-1]) + 1
        return links

    def _entry(self, queries: np.ndarray, limit: int) -> np.ndarray:
        """Where to enter the next lower layer, among its first ``limit`` nodes."""
        if not self.links:
            return np.zeros((len(queries), 1), np.int64)
        top = min(len(self.links[-1]), limit)
        entry = _top(queries @ self.x[:top].T, 4) if top <= 512 else np.zeros((len(queries), 1), np.int64)
        for links in reversed(self.links[:-1] if len(self.links) > 1 else []):
            if len(links) > limit:
                break
            nodes, sims, _ = beam_search(self.x, links, queries, entry, 8)
            entry = np.where(sims > -2.0, nodes, nodes[:, :1])
        return entry

    def within(self, queries: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs at a similarity of at least ``threshold``: the beam's and all that are reached from them
        through such nodes."""
        lowest, rest = self.links[0], Graph(self.x, self.links[1:], self.beam)
        entry = rest._entry(queries, len(lowest))
        if rest.links:
            nodes, sims, _ = beam_search(self.x, rest.links[0], queries, entry, 8)
            entry = np.where(sims > -2.0, nodes, nodes[:, :1])
        _, _, seen = beam_search(self.x, lowest, queries, entry, beam)
        row, node = np.nonzero(seen >= threshold)
        out = [(row, node)]
        while len(row):
            far = np.repeat(row, lowest.shape[1])
            near = lowest[node].ravel()
            fresh = np.flatnonzero(near >= 0)
            far, near = far[fresh], near[fresh]
            fresh = seen[far, near] == -2.0
            key = np.unique(far[fresh].astype(np.int64) * len(lowest) + near[fresh])
            row, node = key // len(lowest), key % len(lowest)
            s = np.einsum("id,id->i", queries[row], self.x[node])
            seen[row, node] = s
            row, node = row[s >= threshold], node[s >= threshold]
            out.append((row, node))
        return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])

    def audited_beam(self, threshold: float) -> int:
        """The beam, doubled until the links of the audit nodes are found."""
        n = len(self.x)
        some = np.unique(np.linspace(0, n - 1, min(n, AUDIT)).astype(int))
        hits = self.x[some] @ self.x.T >= threshold
        true = hits.sum() - hits[np.arange(len(some)), some].sum()  # a node always finds itself
        beam = self.beam
        while beam < n:
            found = 0
            for i in range(0, len(some), BATCH):
                part = some[i : i + BATCH]
                row, node = self.within(self.x[part], threshold, beam)
                found += (node != part[row]).sum()
            if found >= RECALL * true:
                break
            beam *= 2
        return min(beam, max(n, 1))


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _graph_of(pdf: pd.DataFrame) -> pd.DataFrame:
    raw = np.array(pdf["embedding"].tolist(), np.float64)
    graph, order = Graph.build(_unit(raw))
    beam = graph.audited_beam(THRESHOLD - 1e-4)
    body = _packed(ids=pdf["rep"].to_numpy()[order], times=pdf["times"].to_numpy()[order], raw=raw[order], beam=np.array(beam),
                   layers=np.array(len(graph.links)), **{f"links{i}": x for i, x in enumerate(graph.links)})
    return pd.DataFrame({c: pdf[c][:1] for c in ("label", "dim", "shard", "chunks")} | {"graph": [body]})


def _block_of(pdf: pd.DataFrame) -> pd.DataFrame:
    body = _packed(ids=pdf["rep"].to_numpy(), raw=np.array(pdf["embedding"].tolist(), np.float64))
    return pd.DataFrame({c: pdf[c][:1] for c in ("label", "dim", "block", "shards")} | {"queries": [body]})


def _search(threshold: float):
    def one(net: Graph, raw: np.ndarray, ids: np.ndarray, times: np.ndarray, beam: int, queries: bytes) -> pd.DataFrame:
        q = np.load(io.BytesIO(queries))
        unit = _unit(q["raw"]).astype(np.float32)
        size, own = np.linalg.norm(q["raw"], axis=1), np.linalg.norm(raw, axis=1)
        rows, nodes = [], []
        for i in range(0, len(unit), BATCH):
            row, node = net.within(unit[i : i + BATCH], threshold - 1e-4, beam)
            row = row + i
            for k in range(0, len(row), 100_000):
                r, c = row[k : k + 100_000], node[k : k + 100_000]
                cosine = np.einsum("id,id->i", q["raw"][r], raw[c]) / (size[r] * own[c])
                rows.append(r[cosine >= threshold])
                nodes.append(c[cosine >= threshold])
        row, node = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, nodes))
        other = q["ids"][row] != ids[node]
        row, node = row[other], node[other]
        found = np.bincount(row, times[node].astype(np.float64), minlength=len(unit)).astype(np.int64)
        # Roots inside this task, so that a group of alike vectors sends one row per member.
        root_q, root_n = q["ids"].copy(), ids.copy()
        same = {v: i for i, v in enumerate(ids.tolist())}
        twin = np.array([same.get(v, -1) for v in q["ids"].tolist()], np.int64)
        both = np.flatnonzero(twin >= 0)
        while len(row):
            before = root_q.sum(dtype=np.float64) + root_n.sum(dtype=np.float64)
            np.minimum.at(root_q, row, root_n[node])
            np.minimum.at(root_n, node, root_q[row])
            least = np.minimum(root_q[both], root_n[twin[both]])
            root_q[both], root_n[twin[both]] = least, least
            if root_q.sum(dtype=np.float64) + root_n.sum(dtype=np.float64) == before:
                break
        moved = np.flatnonzero(root_n != ids)
        return pd.DataFrame({
            "id": np.concatenate([q["ids"], ids[moved]]),
            "n": np.concatenate([found, np.zeros(len(moved), np.int64)]),
            "root": np.concatenate([root_q, root_n[moved]]),
        })

    def run(blocks: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("id", "n", "root")})]
        for graph in graphs["graph"]:
            g = np.load(io.BytesIO(graph))
            raw, beam = g["raw"], int(g["beam"])
            net = Graph(_unit(raw).astype(np.float32), [g[f"links{i}"] for i in range(int(g["layers"]))], beam)
            out += [one(net, raw, g["ids"], g["times"], beam, queries) for queries in blocks["queries"]]
        return pd.concat(out)

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
                 key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: ``record`` (all columns), ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared if their labels are equal and not null and they have as many components. Vectors that are
    null, empty, all zero or hold a null, NaN or infinity, and rows without a key, link with nothing. Equal vectors of a
    label are linked and count one by one. Rows of one key are separate vectors that share one id and its links. An empty table gives no rows.
    """
    v = F.col(f"record.`{vector}`")
    numbers = F.transform(v, lambda c: c.cast("double"))
    sound = F.forall(numbers, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(numbers, lambda c: c != 0.0)
    base = vectors.select(F.struct("*").alias("record")).select(
        "record", F.col(f"record.`{key}`").cast("bigint").alias("id"), F.col(f"record.`{label}`").alias("label"), numbers.alias("embedding"))
    base = base.withColumn("valid", F.coalesce(sound & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False)))
    base = base.withColumn("k1", F.xxhash64("label", "embedding")).withColumn("k2", F.md5(F.concat_ws(",", F.col("embedding").cast("array<string>"))))
    nodes = materialise(
        base.where("valid").groupBy("label", "k1", "k2").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("times"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")), "nodes")
    # Stored, so that its size decides how it meets the nodes: a label may hold a third of them.
    sizes = materialise(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "sizes")
    mark = F.xxhash64(F.col("rep"))
    shards, cuts = F.ceil(F.col("n") / shard_rows), F.ceil(F.col("n") / block_rows)
    dealt = nodes.join(sizes, ["label", "dim"]).select(
        "label", "dim", "rep", "times", "embedding",
        F.pmod(mark, shards).alias("shard"), F.pmod(mark, cuts).alias("block"),
        shards.alias("shards"), F.ceil(cuts / CHUNK).alias("chunks"))
    kind = nodes.schema["label"].dataType.simpleString()
    graphs = materialise(
        dealt.groupBy("label", "dim", "shard").applyInPandas(_graph_of, f"label {kind}, dim int, shard long, chunks long, graph binary"), "graphs")
    blocks = dealt.groupBy("label", "dim", "block").applyInPandas(_block_of, f"label {kind}, dim int, block long, shards long, queries binary")
    # A shard's graph meets the blocks of one chunk at a time: of any label, a group is one graph and CHUNK blocks at most.
    pair = ["label", "dim", "shard", "chunk"]
    sent = blocks.withColumn("chunk", F.floor(F.col("block") / CHUNK)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    visited = graphs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    searched = materialise(
        sent.select(*pair, "queries").groupBy(*pair).cogroup(visited.select(*pair, "graph").groupBy(*pair))
        .applyInPandas(_search(threshold), "id long, n long, root long"), "found")
    counts = searched.groupBy("id").agg(F.sum("n").alias("found")).withColumnRenamed("id", "rep")
    roots = components(searched.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b")))
    classes = (
        nodes.select("label", "k1", "k2", "rep", "times").join(counts, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("label").alias("of"), "k1", "k2", (F.coalesce("found", F.lit(0)) + F.col("times") - 1).alias("links"),
                F.coalesce("root", "rep").alias("top"))
    )
    twin = classes.select("of", F.col("k1").alias("m1"), F.col("k2").alias("m2"), "links", "top")
    joined = base.join(twin, F.col("valid") & (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")) & (F.col("label") == F.col("of")), "left")
    component = F.coalesce("top", "id")
    return joined.select(
        "record", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))
