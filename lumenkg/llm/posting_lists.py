"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component so that the largest inner product is the
nearest point. A bounded sample is split into balanced clusters; each vector
joins the list of its nearest centroid, boundary vectors several lists.
Centroids are searched through an in-memory neighbour graph. A query visits
the lists whose centroid distance is within a ratio of the nearest one's, and
is scored against their vectors in double precision. The ratio is fitted on the
sample: the least one with which ``target`` of the nearest neighbours within the
sample lie in visited lists. So clustered vectors are pruned hard, and vectors
without structure as far as the target allows.

Lists are balanced on the vectors themselves: lists of over ``FULL`` times the mean
are split, by clusters of a bounded sample of what they hold, and the vectors in
them dealt anew, ``split_rounds`` times at most; what is still too long then
(vectors that no centroid tells apart) is dealt by hash into parts that are
visited together.

The lists of a shelf are scored in one task, which hands on each query's best
once; long shelves are cut into blocks, and so are the queries that visit them,
so no task holds a whole one. Lists grow in number with the vectors; beyond
``max_lists`` they grow in length, and only the time of a search with them.

Equal vectors form one class that is indexed and searched once; a class needs
no more of its members than a query returns neighbours plus itself.

Defined results: vectors that are null, zero, or hold null or non-finite
components, rows with a null id, and vectors of other than the most frequent
dimension take no part; repeated rows count once; an id with several vectors is
searched and found by each of them, an answer names an id once with its best
score, and one that names it by several vectors is shorter by as many; ties go
to the smaller id; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.llm.text import mix
from lumenkg.llm.workspace import materialise


#: Lists of over so many times the mean are split.
FULL = 1.75


@dataclass(frozen=True)
class IndexOptions:
    """``sample`` vectors at most reach the driver; lists number ``rows / list_size``, ``max_lists`` at most;
    ``probe_ratio`` takes the place of the fitted ratio."""

    sample: int = 16384
    list_size: int = 32
    shelf: int = 256
    max_lists: int = 4096
    degree: int = 16
    beam: int = 32
    max_copies: int = 2
    copy_ratio: float = 1.03
    target: float = 0.93
    probe_ratio: float | None = None
    trials: int = 256
    block: int = 16384
    split_rounds: int = 1
    seed: int = 5


@dataclass
class CentroidGraph:
    """Centroids, each linked to its nearest others and a few random ones; searches start at the nearest of ``entries``."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    def search(self, x: np.ndarray, beam: int, ratio: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(lists, squared distances) of about the ``beam`` nearest centroids of each row, nearest first.

        Centroids farther than ``ratio`` times the nearest one so far are not followed.
        """
        n, c = len(x), len(self.centroids)
        beam = min(beam, c)
        norms = (self.centroids**2).sum(axis=1)
        own = (x**2).sum(axis=1)
        start = own[:, None] + norms[self.entries] - 2 * x @ self.centroids[self.entries].T
        first = np.argsort(start, axis=1, kind="stable")[:, :8]
        ids = np.full((n, beam), -1)
        dist = np.full((n, beam), np.inf)
        k = min(first.shape[1], beam)
        ids[:, :k] = self.entries[first[:, :k]]
        dist[:, :k] = np.take_along_axis(start, first[:, :k], axis=1)
        rows = np.arange(n)
        seen = np.zeros((n, c), dtype=bool)
        seen[rows[:, None], ids[:, :k]] = True
        done = np.zeros((n, c), dtype=bool)
        for _ in range(c):
            waiting = np.where((ids >= 0) & ~done[rows[:, None], ids] & (dist <= ratio * ratio * np.maximum(dist[:, :1], 1e-12)), dist, np.inf)
            pick = np.argsort(waiting, axis=1, kind="stable")[:, :4]
            live = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
            if not live.any():
                break
            chosen = np.take_along_axis(ids, pick, axis=1)
            done[np.repeat(rows, live.sum(axis=1)), chosen[live]] = True
            near = np.where(live[:, :, None], self.links[chosen], -1).reshape(n, -1)
            fresh = (near >= 0) & ~seen[rows[:, None], near]
            r, at = np.nonzero(fresh)
            node = near[r, at]
            seen[r, node] = True
            d = np.full(near.shape, np.inf)
            d[r, at] = own[r] + norms[node] - 2 * np.einsum("ij,ij->i", x[r], self.centroids[node])
            same = np.sort(np.where(fresh, near, -1), axis=1)
            if (same[:, 1:] == same[:, :-1])[same[:, 1:] >= 0].any():  # one node offered twice in a round
                order = np.argsort(np.where(fresh, near, c + 1), axis=1, kind="stable")
                ranked = np.take_along_axis(np.where(fresh, near, c + 1), order, axis=1)
                twice = np.zeros_like(fresh)
                np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
                d[twice] = np.inf
            all_d, all_i = np.concatenate([dist, d], axis=1), np.concatenate([ids, near], axis=1)
            keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist, ids = np.take_along_axis(all_d, keep, axis=1), np.take_along_axis(all_i, keep, axis=1)
            ids[~np.isfinite(dist)] = -1
        return ids, np.maximum(dist, 0)

    def within(self, x: np.ndarray, ratio: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the centroids at most ``ratio`` times as far as the nearest one found, reached over links from such."""
        c, norms, own = len(self.centroids), (self.centroids**2).sum(axis=1), (x**2).sum(axis=1)
        start, near = self.search(x, beam)
        bound = ratio * ratio * np.maximum(near[:, 0], 1e-12)
        first = (start >= 0) & (near <= bound[:, None])
        first[:, 0] = True
        row, at = np.nonzero(first)
        seen = np.zeros((len(x), c), bool)
        fresh = (row, start[row, at])
        seen[fresh] = True
        found = [fresh]
        while len(fresh[0]):
            row, node = np.repeat(fresh[0], self.links.shape[1]), self.links[fresh[1]].ravel()
            ok = node >= 0
            pair = np.unique(row[ok] * c + node[ok])
            row, node = pair // c, pair % c
            new = ~seen[row, node]
            row, node = row[new], node[new]
            seen[row, node] = True
            close = own[row] + norms[node] - 2 * np.einsum("ij,ij->i", x[row], self.centroids[node]) <= bound[row]
            fresh = row[close], node[close]
            found.append(fresh)
        return np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])


def _halves(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A balanced cut in two: two-means directions, then the median of the difference of distances."""
    a, b = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(6):
        side = ((x - a) ** 2).sum(axis=1) < ((x - b) ** 2).sum(axis=1)
        if side.all() or not side.any():
            break
        a, b = x[side].mean(axis=0), x[~side].mean(axis=0)
    order = np.argsort(((x - a) ** 2).sum(axis=1) - ((x - b) ** 2).sum(axis=1), kind="stable")
    side = np.zeros(len(x), dtype=bool)
    side[order[: len(x) // 2]] = True
    return side


def build_graph(sample: np.ndarray, n_lists: int, options: IndexOptions) -> CentroidGraph:
    """Balanced clusters of the sample by repeated halving, a few Lloyd rounds, and the graph over their centroids."""
    rng = np.random.default_rng(options.seed)
    groups = [np.arange(len(sample))]
    while len(groups) < n_lists:
        groups.sort(key=len)
        g = groups.pop()
        if len(g) < 2:
            groups.append(g)
            break
        side = _halves(sample[g], rng)
        groups += [g[side], g[~side]]
    centroids = np.unique(np.array([sample[g].mean(axis=0) for g in groups]), axis=0)
    for _ in range(3):
        near = np.concatenate([
            ((centroids**2).sum(axis=1) - 2 * sample[at : at + 512] @ centroids.T).argmin(axis=1) for at in range(0, len(sample), 512)
        ])
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return link_centroids(np.unique(centroids, axis=0), options)


def link_centroids(centroids: np.ndarray, options: IndexOptions) -> CentroidGraph:
    """The graph over centroids."""
    rng = np.random.default_rng(options.seed)
    c, norms = len(centroids), (centroids**2).sum(axis=1)
    links = np.full((c, options.degree + 4), -1)
    for at in range(0, c, 512):
        d = norms - 2 * centroids[at : at + 512] @ centroids.T
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        near = np.argsort(d, axis=1, kind="stable")[:, : min(options.degree, c - 1)]
        links[at : at + 512, : near.shape[1]] = near
    links[:, options.degree :] = rng.integers(0, c, (c, 4))
    entries = rng.choice(c, min(c, max(16, int(4 * np.sqrt(c)))), replace=False)
    return CentroidGraph(centroids, links, np.sort(entries))


def split_centroids(g: CentroidGraph, full: dict[int, tuple[np.ndarray, int]], options: IndexOptions) -> CentroidGraph:
    """The graph with each list of ``full`` (list: sample of its vectors, number of parts) replaced by clusters of its sample."""
    rng, centroids = np.random.default_rng(options.seed), [g.centroids.copy()]
    for k, (sample, parts) in full.items():
        groups = [np.arange(len(sample))]
        while len(groups) < parts:
            groups.sort(key=len)
            if len(groups[-1]) < 2:
                break
            own = groups.pop()
            side = _halves(sample[own], rng)
            groups += [own[side], own[~side]]
        made = np.array([sample[x].mean(axis=0) for x in groups])
        centroids[0][k] = made[0]  # the others come behind, so all lists keep their numbers
        centroids.append(made[1:])
    return link_centroids(np.concatenate(centroids), options)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dim)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(top * top - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def _copies(g: CentroidGraph, x: np.ndarray, options: IndexOptions) -> tuple[np.ndarray, np.ndarray]:
    """(lists, kept): near lists of stored vectors, and in which of them they are kept."""
    ids, d = g.search(x, options.beam)
    d, keep = np.sqrt(d), np.zeros(ids.shape, dtype=bool)
    keep[:, 0] = True
    for j in range(1, min(2 * options.max_copies, ids.shape[1])):
        near = (ids[:, j] >= 0) & (d[:, j] <= options.copy_ratio * d[:, 0]) & (keep.sum(axis=1) < options.max_copies)
        for i in range(j):  # a list close to one already chosen adds little
            gap = np.linalg.norm(g.centroids[ids[:, j]] - g.centroids[ids[:, i]], axis=1)
            near &= ~(keep[:, i] & (gap < d[:, j] * 0.5))
        keep[:, j] = near
    return ids, keep


def _asking(x: np.ndarray, top: float) -> np.ndarray:
    """Queries as points: scaled to the longest vector, with nothing in the added component."""
    return np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True) * top, np.zeros((len(x), 1))], axis=1)


def fit_ratio(g: CentroidGraph, sample: np.ndarray, top: float, k: int, options: IndexOptions) -> float:
    """The least distance ratio with which ``target`` of the ``k`` nearest within the sample lie in visited lists."""
    rng = np.random.default_rng(options.seed)
    chosen = rng.choice(len(sample), min(options.trials, len(sample)), replace=False)
    raw = sample[:, :-1]
    asked = raw[chosen]
    near = np.zeros((len(chosen), min(k, max(len(sample) - 1, 1))), np.int64)
    for at in range(0, len(chosen), 32):
        score = asked[at : at + 32] @ raw.T
        score[np.arange(len(score)), chosen[at : at + 32]] = -np.inf
        near[at : at + 32] = np.argpartition(score, -near.shape[1], axis=1)[:, -near.shape[1] :]
    hit = np.unique(near)
    some = [_copies(g, sample[hit[a : a + 256]], options) for a in range(0, len(hit), 256)]  # a search holds its rows' neighbours
    lists, keep = (np.concatenate(c) for c in zip(*some))
    x = _asking(asked, top)
    d = np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (g.centroids**2).sum(axis=1) - 2 * x @ g.centroids.T, 0))
    least = np.maximum(d.min(axis=1), 1e-6)
    at = np.searchsorted(hit, near)
    reach = np.where(keep[at], d[np.arange(len(x))[:, None, None], lists[at]], np.inf).min(axis=2)
    return float(np.quantile(reach / least[:, None], options.target))


def _shelved(ids: pa.Array, vectors: pa.Array, row: np.ndarray, lists: np.ndarray, shelf: int) -> pa.RecordBatch:
    """(class_id, v, shelf, lists): one row per vector and shelf."""
    order = np.lexsort((lists, row))
    row, lists = row[order], lists[order]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (lists[1:] // shelf != lists[:-1] // shelf)
    first = np.flatnonzero(head)
    groups = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(lists, pa.int32()))
    take = pa.array(row[first])
    return pa.RecordBatch.from_arrays([ids.take(take), vectors.take(take), pa.array(lists[first] // shelf, pa.int32()), groups], names=["class_id", "v", "shelf", "lists"])


def _parted(lists: np.ndarray, row: np.ndarray, own: np.ndarray | None, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, stored list) of lists dealt into ``parts``: one part by the hash of ``own``, or all parts of it."""
    first = np.concatenate([[0], np.cumsum(parts)])
    if own is not None:
        return row, first[lists] + (mix(own.astype(np.uint64)[row]) % parts[lists].astype(np.uint64)).astype(np.int64)
    n = parts[lists]
    return np.repeat(row, n), np.repeat(first[lists], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _dealt_rows(parts: np.ndarray, shelf: int):
    """Stored vectors (class_id, v, lists) on the shelves of their lists' parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = np.repeat(np.arange(b.num_rows), b.column(2).value_lengths().to_numpy(zero_copy_only=False))
            row, lists = _parted(b.column(2).flatten().to_numpy(zero_copy_only=False), row, b.column(0).to_numpy(), parts)
            yield _shelved(b.column(0), b.column(1), row, lists, shelf)

    return run


def _list_rows(graph, dim: int, top: float, options: IndexOptions, parts: np.ndarray | None = None, ratio: float | None = None, sizes: np.ndarray | None = None, least: int = 0):
    """The lists a vector is stored in, or those a query visits if a ratio is given: all within it, and the nearest ones
    until they hold ``least`` vectors. ``parts`` says how many stored lists stand for each that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        step = max(16, min(512, (1 << 20) // len(g.centroids)))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                b = whole.slice(lo, step)
                x = _matrix(b.column(1), dim)
                if ratio is None:
                    ids, keep = _copies(g, _augmented(x, top), options)
                    row, at = np.nonzero(keep)
                    lists = ids[row, at]
                else:
                    x = _asking(x, top)
                    row, lists = g.within(x, ratio, options.beam)
                    near, _ = g.search(x, options.beam)
                    held = np.where(near >= 0, sizes[near], 0)
                    at = np.nonzero((near >= 0) & (np.cumsum(held, axis=1) - held < least))
                    pair = np.unique(np.concatenate([row, at[0]]) * len(sizes) + np.concatenate([lists, near[at]]))
                    row, lists = pair // len(sizes), pair % len(sizes)
                if parts is not None:
                    row, lists = _parted(lists, row, None, parts)
                yield _shelved(b.column(0), b.column(1), row, lists, options.shelf)

    return run


def _members(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of each element of a column of lists."""
    column = column.combine_chunks()
    return np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False)), column.flatten().to_numpy()


def _score_block(dim: int, k: int):
    """Best ``k`` of each query over the lists of one shelf block; a query is scored against the lists it visits only."""

    def run(key, queries: pa.Table, postings: pa.Table) -> pa.Table:
        kinds = pa.schema([("q", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not postings.num_rows:
            return kinds.empty_table()
        postings = postings.sort_by("class_id")
        q, p = _matrix(queries["v"].combine_chunks(), dim), _matrix(postings["v"].combine_chunks(), dim)
        qid, pid = queries["class_id"].to_numpy(), postings["class_id"].to_numpy()
        (qrow, qlist), (prow, plist) = _members(queries["lists"]), _members(postings["lists"])
        order = np.argsort(plist, kind="stable")
        prow, plist = prow[order], plist[order]
        found = []
        for at in range(0, len(q), 256):
            mine = (qrow >= at) & (qrow < at + 256)
            rows, lists = qrow[mine] - at, qlist[mine]
            n = min(256, len(q) - at)
            scores = np.full((n, len(p)), -np.inf)
            by = np.argsort(lists, kind="stable")
            rows, lists = rows[by], lists[by]
            for one in np.unique(lists):
                a = rows[np.searchsorted(lists, one) : np.searchsorted(lists, one, side="right")]
                stored = prow[np.searchsorted(plist, one) : np.searchsorted(plist, one, side="right")]
                if len(stored):
                    scores[a[:, None], stored[None, :]] = q[at + a] @ p[stored].T
            some = min(k + 4, len(p))
            best = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            exact = np.einsum("ijk,ik->ij", p[best], q[at : at + n])
            exact[~np.isfinite(np.take_along_axis(scores, best, axis=1))] = -np.inf
            found.append((np.repeat(qid[at : at + n], some), pid[best].ravel(), exact.ravel()))
        ask, hit, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((hit, -score, ask))
        ask, hit, score = ask[order], hit[order], score[order]
        place = np.arange(len(ask)) - np.searchsorted(ask, ask)
        keep = (place < k) & np.isfinite(score)
        return pa.table([ask[keep], hit[keep], score[keep]], schema=kinds)

    return run


def _cuts(postings: DataFrame, visits: DataFrame, options: IndexOptions) -> DataFrame:
    """(shelf, np, nq): blocks of each shelf and of its queries, ``max_lists / shelf`` rows at most."""
    parts = lambda df, name: df.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / options.block).cast("int").alias(name))
    return F.broadcast(parts(postings, "np").join(parts(visits, "nq"), "shelf"))


def index_tables(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", options: IndexOptions = IndexOptions()
) -> tuple[int, DataFrame, DataFrame, DataFrame] | None:
    """(dimension, members(vec_id, class_id, least), postings, visits): the lists each class is stored in, and those each
    class of a query visits; None if no vector takes part."""
    spark = vectors.sparkSession
    v = F.col("v")
    sound = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.coalesce(sound & F.exists(v, lambda c: c != 0), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("top"))
    found = sizes.orderBy(F.desc("n"), "dim").first()
    if found is None:
        return None
    dim, top = found["dim"], float(np.sqrt(found["top"]))
    rows = rows.filter(F.size("v") == dim)
    classes = rows.groupBy("v").agg(F.min("vec_id").alias("least"))
    classes = materialise(classes.withColumn("class_id", F.monotonically_increasing_id()), "vectors")
    members = materialise(rows.join(classes, "v").select("vec_id", "class_id", "least").distinct(), "members")
    n = classes.count()
    n_lists = min(max(n // options.list_size, 1), options.max_lists)
    picked = classes.orderBy(F.xxhash64("v"), "v").limit(options.sample).select("v").toArrow()
    sample = _augmented(_matrix(picked["v"].combine_chunks(), dim), top)
    built = build_graph(sample, n_lists, options)
    ratio = options.probe_ratio
    rows_of = "class_id long, v array<double>, shelf int, lists array<int>"
    both = classes.select("class_id", "v")

    place = lambda some: some.mapInArrow(_list_rows(spark.sparkContext.broadcast(built), dim, top, options), rows_of)
    postings, parts = materialise(place(both), "postings"), None
    sizes = _sizes(postings, len(built.centroids))
    for turn in range(options.split_rounds + 1):
        most = FULL * sizes.sum() / len(sizes)  # splitting lowers the mean, and leaves none over twice of it
        longest = [int(k) for k in np.argsort(-sizes) if sizes[k] > most]
        if not longest or turn == options.split_rounds:
            break
        split = {k: int(-(-sizes[k] // max(most / FULL, 1))) for k in longest}
        built = split_centroids(built, _samples_of(postings, sizes, split, dim, top, options), options)
        touched = postings.filter(F.arrays_overlap("lists", F.array(*map(F.lit, longest)))).select("class_id").distinct()
        anew = place(both.join(touched, "class_id", "left_semi"))
        postings = materialise(postings.join(touched, "class_id", "left_anti").unionByName(anew), "postings")
        sizes = _sizes(postings, len(built.centroids))
    if longest:
        parts = np.maximum(np.where(sizes > most, -(-sizes // max(int(most / FULL), 1)), 1), 1)
        whole = postings.groupBy("class_id").agg(F.first("v").alias("v"), F.flatten(F.collect_list("lists")).alias("lists"))
        postings = materialise(whole.mapInArrow(_dealt_rows(parts, options.shelf), rows_of), "postings")
    if options.probe_ratio is None:
        ratio = fit_ratio(built, sample, top, k, options)
    asked = both.join(members.filter(is_query).select("class_id").distinct(), "class_id")
    visiting = _list_rows(spark.sparkContext.broadcast(built), dim, top, options, parts, ratio, sizes, 2 * options.max_copies * (k + 1))
    return dim, members, postings, materialise(asked.mapInArrow(visiting, rows_of), "visits")


def _sizes(postings: DataFrame, lists: int) -> np.ndarray:
    """Number of vectors of each list; a row per list reaches the driver."""
    sizes = np.zeros(lists, np.int64)
    for r in postings.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["list"]] = r["n"]
    return sizes


def _samples_of(postings: DataFrame, sizes: np.ndarray, parts: dict[int, int], dim: int, top: float, options: IndexOptions) -> dict[int, tuple[np.ndarray, int]]:
    """(sample of its vectors, number of parts) of each list of ``parts``: about 32 vectors a part, ``sample`` in all."""
    share = min(1.0, options.sample / (64 * sum(parts.values())))
    wanted = F.create_map(*[F.lit(x) for k, n in parts.items() for x in (k, min(1.0, share * 32 * n / sizes[k]))])
    rows = postings.select("class_id", "v", F.explode("lists").alias("list")).filter(F.col("list").isin(list(parts)))
    low = F.pmod(F.xxhash64("class_id", "list"), F.lit(1 << 20)) / F.lit(1 << 20)
    some = rows.filter(low <= wanted[F.col("list")]).select("list", "v").limit(options.sample).toArrow()
    lists, found = some["list"].to_numpy(), _augmented(_matrix(some["v"].combine_chunks(), dim), top)
    return {k: (found[lists == k], n) for k, n in parts.items() if (lists == k).sum() > 1}


def search(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", options: IndexOptions = IndexOptions()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query`` (a condition on ``vec_id``)."""
    tables = index_tables(vectors, is_query, k, id_col, vector_col, options)
    if tables is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, members, postings, visits = tables
    asked_ids = members.filter(is_query)
    cuts = _cuts(postings, visits, options)
    block = lambda c: F.pmod(F.xxhash64("class_id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = visits.join(cuts, "shelf").select("shelf", "lists", "class_id", "v", block("nq").alias("qb"), every("np").alias("pb"))
    right = postings.join(cuts, "shelf").select("shelf", "lists", "class_id", "v", every("nq").alias("qb"), block("np").alias("pb"))
    key = ["shelf", "qb", "pb"]
    scored = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_score_block(dim, k + 1), "q long, class_id long, score double")
    scored = scored.groupBy("q", "class_id").agg(F.max("score").alias("score"))  # a copy in two lists
    scored = scored.join(members.select("class_id", "least").distinct(), "class_id")
    nearest = lambda c: Window.partitionBy("q").orderBy(F.desc("score"), c)
    best = scored.withColumn("r", F.row_number().over(nearest("least"))).filter(F.col("r") <= k + 1)
    shown = members.withColumn("r", F.row_number().over(Window.partitionBy("class_id").orderBy("vec_id"))).filter(F.col("r") <= k + 1).select("vec_id", "class_id")
    spread = best.select("q", "class_id", "score").join(shown, "class_id")
    spread = spread.withColumn("r", F.row_number().over(nearest("vec_id"))).filter(F.col("r") <= k + 1)
    answers = asked_ids.select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("q")).join(spread.select("q", "vec_id", "score"), "q")
    answers = answers.filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
