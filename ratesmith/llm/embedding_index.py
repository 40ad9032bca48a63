"""Near-duplicate vectors by an inverted multi-index.

1. Vectors are scaled to length 1 in double precision; equal ones are one from here on, with a
   number of copies.
2. Two codebooks, one for each half of the components, are fitted on a bounded sample (at most
   `SAMPLE_VALUES` components). Their product is a grid of at most `MOST_WORDS` squared cells; every
   vector lies in its nearest cell.
3. A vector visits cells in the order of the multi-sequence traversal, nearest first, until
   the distance exceeds that of its own cell by a gap. The gap is the `TARGET_RECALL` quantile of
   what sampled vectors need to meet a vector turned away from them by exactly the limit's
   angle. Two vectors meet if one of them visits the cell of the other.
4. Inside a cell, vectors within half the limit's angle of a common centre form a ball: all of
   them link, whatever their number, and none of their pairs is looked at.
5. Balls meet in the cells they visit, in blocks of bounded size, by their centres in 8 bits and
   a radius that includes the rounding. Centres near enough link all of both balls, centres far
   enough none; only what neither holds for is verified on the vectors themselves, in double
   precision. Tasks return counts per ball or vector and a forest of links, never all pairs.

Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing; shorter vectors
count as ending in zeros. Repeated rows are vectors of their own. Rows without a vec_id count as
links of others; a component is named by the smallest vec_id it has. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.common import ROW, numbered
from ratesmith.llm.components import components
from ratesmith.sources.workspace import staged

SAMPLE_VALUES = 1_280_000
MOST_WORDS = 512
CELL_VECTORS = 16
ROUNDS = 8
CALIBRATED = 2000
TARGET_RECALL = 0.99
BLOCK = 2048
VISITORS = 1024
SLACK = 1e-6


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """Components as doubles; None for vectors that link with nothing."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = column.offsets.to_numpy()
    known = column.is_valid().to_numpy(zero_copy_only=False)
    found = []
    for at in range(len(column)):
        vector = values[offsets[at]:offsets[at + 1]]
        usable = known[at] and len(vector) and np.isfinite(vector).all() and vector.any()
        found.append(vector + 0.0 if usable else None)
    return found


def unit_matrix(column: pa.Array, size: int) -> np.ndarray:
    """Usable vectors of length 1 as rows."""
    matrix = np.zeros((len(column), size))
    for at, vector in enumerate(rows_of(column)):
        scaled = vector / np.abs(vector).max()
        matrix[at, :len(vector)] = scaled / np.linalg.norm(scaled)
    return matrix


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A 128-bit key of each usable vector as two integers."""
    for batch in batches:
        keys = [vector is not None and sha256(vector.tobytes()).digest()[:16]
                for vector in rows_of(batch["embedding"])]
        pairs = np.frombuffer(b"".join(key or b"\0" * 16 for key in keys), "<i8").reshape(-1, 2)
        missing = np.array([not key for key in keys], bool)
        yield pa.RecordBatch.from_arrays(
            [batch[ROW], batch["vec_id"], batch["embedding"],
             pa.array(pairs[:, 0], mask=missing), pa.array(pairs[:, 1], mask=missing)],
            names=[ROW, "vec_id", "embedding", "key_a", "key_b"])


def squared_distances(vectors: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum(0, (vectors**2).sum(1)[:, None] - 2 * vectors @ words.T + (words**2).sum(1))


def codebook(vectors: np.ndarray, words: int, seed: int) -> np.ndarray:
    """Centres of `words` groups of the vectors."""
    centres = vectors[np.random.default_rng(seed).choice(len(vectors), words, False)].copy()
    for _ in range(ROUNDS):
        nearest = squared_distances(vectors, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        counts = np.bincount(nearest, minlength=words)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class MultiIndex:
    """Two codebooks, the grid of their pairs and the gap at which a traversal ends."""

    def __init__(self, sample: np.ndarray, vectors: int, limit: float, target: float = TARGET_RECALL):
        self.half = sample.shape[1] // 2
        words = int(min(max(2, (vectors / CELL_VECTORS) ** 0.5), MOST_WORDS, max(1, len(sample) // 16)))
        self.books = [codebook(part, words, seed) for seed, part in enumerate(self._parts(sample))]
        self.gap = self._calibrated(sample[:CALIBRATED], limit, target)

    def _parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, :self.half], vectors[:, self.half:]]

    def _distances(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [squared_distances(part, book) for part, book in zip(self._parts(vectors), self.books)]

    def _calibrated(self, vectors: np.ndarray, limit: float, target: float) -> float:
        """What a pair at the limit needs: turned in random directions and towards other vectors."""
        random = np.random.default_rng(2)
        needed = []
        for towards in (random.normal(size=vectors.shape), vectors[random.permutation(len(vectors))]):
            across = towards - (towards * vectors).sum(1)[:, None] * vectors
            length = np.linalg.norm(across, axis=1)
            own, across = vectors[length > SLACK], across[length > SLACK] / length[length > SLACK, None]
            if len(own):
                turned = limit * own + (1 - limit**2) ** 0.5 * across
                needed.append(np.minimum(self._gaps(own, turned), self._gaps(turned, own)))
        return float(np.quantile(np.concatenate(needed), target)) + SLACK if needed else SLACK

    def _gaps(self, visitors: np.ndarray, homes: np.ndarray) -> np.ndarray:
        at = np.arange(len(visitors))
        return sum(seen[at, own.argmin(1)] - seen.min(1)
                   for seen, own in zip(self._distances(visitors), self._distances(homes)))

    def visits(self, vectors: np.ndarray) -> Iterator[list[int]]:
        """Cells each vector visits, nearest first; the first one is its own."""
        words = len(self.books[1])
        first, second = self._distances(vectors)
        orders = first.argsort(1, kind="stable"), second.argsort(1, kind="stable")
        for at in range(len(vectors)):
            one, two = orders[0][at], orders[1][at]
            a, b = first[at][one], second[at][two]
            end = a[0] + b[0] + self.gap
            cells, heap, seen = [], [(a[0] + b[0], 0, 0)], {(0, 0)}
            while heap:
                distance, i, j = heapq.heappop(heap)
                if distance > end:
                    break
                cells.append(int(one[i]) * words + int(two[j]))
                for step in ((i + 1, j), (i, j + 1)):
                    if step[0] < len(a) and step[1] < len(b) and step not in seen:
                        seen.add(step)
                        heapq.heappush(heap, (a[step[0]] + b[step[1]], *step))
            yield cells


def _placed(index: MultiIndex, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, VISITORS):
                part = batch.slice(start, VISITORS)
                cells = list(index.visits(unit_matrix(part["embedding"], size)))
                yield pa.RecordBatch.from_arrays(
                    [part["rep"], part["copies"], part["embedding"],
                     pa.array([own[0] for own in cells], pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                    names=["rep", "copies", "embedding", "cell", "visits"])

    return run


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows with one key; a long run comes in several parts."""
    for batch in batches:
        columns = np.stack([batch[key].to_numpy(zero_copy_only=False) for key in keys]) if batch.num_rows else None
        if columns is None:
            continue
        edges = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield tuple(columns[:, start].tolist()), batch.slice(start, end - start)


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def balls_of(vectors: np.ndarray, limit: float) -> list[tuple[list[int], np.ndarray, float]]:
    """Members, centre and radius of balls in which all pairs are nearer than the limit."""
    angle = float(np.arccos(limit))
    reach = angle / 2 - 1e-3
    near = vectors @ vectors.T >= limit
    open_, balls = np.ones(len(vectors), bool), []
    for at in range(len(vectors)):
        if not open_[at]:
            continue
        group = np.flatnonzero(near[at] & open_)
        members = group
        if len(group) > 1:
            centre = vectors[group].sum(0)
            centre /= np.linalg.norm(centre)
            angles = _angle(vectors[group] @ centre)
            members = group[angles <= reach]
        if len(members) > 1 and at in members:
            balls.append((members.tolist(), centre, float(angles[angles <= reach].max()) + SLACK))
        else:
            members = np.array([at])
            balls.append(([at], vectors[at], 0.0))
        open_[members] = False
    return balls


def _balls(limit: float, size: int):
    def result(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        vectors = unit_matrix(table["embedding"], size)
        reps, copies = table["rep"].to_pylist(), table["copies"].to_pylist()
        visits, cell = table["visits"].to_pylist(), table["cell"][0].as_py()
        found = []
        for members, centre, radius in balls_of(vectors, limit):
            rounded = np.rint(centre / np.abs(centre).max() * 127).astype(np.int8)
            kept = rounded / np.linalg.norm(rounded.astype(float))
            own = sorted(set().union(*(visits[at] for at in members)))
            found.append((min(reps[at] for at in members), cell, rounded.tobytes(),
                          radius + float(_angle(centre @ kept)) + SLACK, sum(copies[at] for at in members),
                          [reps[at] for at in members], own))
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*found), (
                pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.int64(), pa.list_(pa.int64()),
                pa.list_(pa.int32())))],
            names=["ball", "cell", "centre", "radius", "total", "members", "visits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for key, part in _segments(batches, ["cell", "block"]):
            if key != unit and rows:
                yield result(rows)
                rows = []
            unit = key
            rows.append(part)
        if rows:
            yield result(rows)

    return run


class _Unit:
    """Home balls of a block of a cell; visiting balls are held against them as they come."""

    def __init__(self, angle: float):
        self.angle, self.parts, self.ready = angle, [], False
        self.counts: dict[int, int] = {}
        self.edges, self.open = [], []
        self.visitor, self.anchor = None, 0

    def add(self, part: pa.RecordBatch) -> None:
        visiting = part["visiting"].to_numpy(zero_copy_only=False)
        homes = int(np.searchsorted(visiting, True))
        if homes:
            self.parts.append(part.slice(0, homes))
        for start in range(homes, part.num_rows, VISITORS):
            if not self.ready:
                self._settle()
            if len(self.balls):
                self._meet(part.slice(start, VISITORS))

    @staticmethod
    def _centres(part) -> np.ndarray:
        rows = np.stack([np.frombuffer(centre, np.int8) for centre in part["centre"].to_pylist()]).astype(float)
        return rows / np.linalg.norm(rows, axis=1)[:, None]

    def _settle(self) -> None:
        self.ready = True
        home = pa.Table.from_batches(self.parts) if self.parts else None
        self.balls = home["ball"].to_numpy() if home else np.zeros(0, np.int64)
        if home:
            self.centres, self.radii = self._centres(home), home["radius"].to_numpy()
            self.totals, self.cell = home["total"].to_pylist(), home["home"][0].as_py()
            self.visits = [set(own) for own in home["visits"].to_pylist()]
            self.label = list(range(len(self.balls)))

    def _meet(self, part: pa.RecordBatch) -> None:
        angles = _angle(self._centres(part) @ self.centres.T)
        reach = part["radius"].to_numpy()[:, None] + self.radii
        possible = angles - reach <= self.angle
        surely = angles + reach <= self.angle
        balls, homes, totals = (part[name].to_pylist() for name in ("ball", "home", "total"))
        for one, two in zip(*np.nonzero(possible)):
            ball, home, own = balls[one], homes[one], int(self.balls[two])
            # a pair that meets twice counts once
            if home == self.cell and ball >= own or home > self.cell and home in self.visits[two]:
                continue
            if not surely[one, two]:
                self.open.append((ball, own))
                continue
            self.counts[ball] = self.counts.get(ball, 0) + self.totals[two]
            self.counts[own] = self.counts.get(own, 0) + totals[one]
            self._link(ball, own, two)

    def _link(self, ball: int, own: int, two: int) -> None:
        """Keeps a link unless earlier ones of this visitor connect the same home balls."""
        if self.visitor != ball:
            self.visitor, self.anchor = ball, self._root(two)
            self.edges.append((ball, own))
        elif self._root(two) != self._root(self.anchor):
            self.label[self._root(two)] = self._root(self.anchor)
            self.edges.append((ball, own))

    def _root(self, at: int) -> int:
        while self.label[at] != at:
            self.label[at] = self.label[self.label[at]]
            at = self.label[at]
        return at

    def results(self, last: bool) -> Iterator[pa.RecordBatch]:
        if last or len(self.edges) + len(self.open) + len(self.counts) > 20_000:
            rows = [(0, ball, None, n) for ball, n in self.counts.items()]
            rows += [(1, u, v, None) for u, v in self.edges] + [(2, u, v, None) for u, v in self.open]
            self.counts, self.edges, self.open = {}, [], []
            if rows:
                yield _found(rows)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
        names=["kind", "u", "v", "links"])


FOUND = "kind int, u long, v long, links long"
COUNT, EDGE, OPEN = 0, 1, 2


def _met(angle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit = None, None
        for own, part in _segments(batches, ["cell", "block"]):
            if own != key:
                if unit:
                    yield from unit.results(True)
                key, unit = own, _Unit(angle)
            unit.add(part)
            yield from unit.results(False)
        if unit:
            yield from unit.results(True)

    return run


def _verified(limit: float, size: int):
    """Links of the members of two balls: counts per vector, one edge between the balls."""

    def result(key: tuple, rows: list[pa.RecordBatch]) -> list[tuple]:
        table = pa.Table.from_batches(rows)
        vectors = unit_matrix(table["embedding"], size)
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        first = table["ball"].to_numpy() == key[0]
        linked = vectors[first] @ vectors[~first].T >= limit
        counts = np.concatenate([linked @ copies[~first], copies[first] @ linked])
        found = [(COUNT, int(rep), None, int(n)) for rep, n in zip(
            np.concatenate([reps[first], reps[~first]]), counts) if n]
        return found + ([(EDGE, *key, None)] if found else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, found = None, [], []
        for own, part in _segments(batches, ["u", "v"]):
            if own != key and rows:
                found += result(key, rows)
                rows = []
                if len(found) > 20_000:
                    yield _found(found)
                    found = []
            key = own
            rows.append(part)
        if rows:
            found += result(key, rows)
        if found:
            yield _found(found)

    return run


def _in_blocks(rows: DataFrame, name: str) -> DataFrame:
    """Adds `block` and `blocks`: large cells are cut so that a block holds about `BLOCK` rows."""
    # at most one row a cell of the grid
    large = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select(
        "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    return rows.join(F.broadcast(large), "cell", "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64(name), F.col("blocks")).cast("int"))


def linked_vectors(embeddings: DataFrame, limit: float = 0.95, target: float = TARGET_RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = embeddings.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    given = numbered(embeddings.select("vec_id", F.col("embedding").cast(kind).alias("embedding")))
    rows = staged(given.select(ROW, F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        _keyed, f"{ROW} long, vec_id long, embedding {kind}, key_a long, key_b long"), "vectors")
    groups = staged(rows.where("key_a IS NOT NULL").groupBy("key_a", "key_b").agg(
        F.min(ROW).alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "vector_groups")
    reps = staged(rows.select(F.col(ROW).alias("rep"), "embedding").join(
        groups.select("rep", "copies"), "rep"), "distinct_vectors")
    shape = reps.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("size")).first()
    if not shape.n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    sample = reps.orderBy(F.xxhash64("rep")).limit(max(32, SAMPLE_VALUES // shape.size)).select("embedding").toArrow()
    index = MultiIndex(unit_matrix(sample["embedding"], shape.size), shape.n, limit, target)
    placed = staged(reps.mapInArrow(
        _placed(index, shape.size),
        f"rep long, copies long, embedding {kind}, cell int, visits array<int>"), "placed_vectors")
    balls = staged(_in_blocks(placed, "rep").repartition("cell", "block").sortWithinPartitions("cell", "block").mapInArrow(
        _balls(limit, shape.size), "ball long, cell int, centre binary, radius double, total long, "
        "members array<long>, visits array<int>"), "balls")
    blocked = _in_blocks(balls, "ball")
    home = blocked.select(
        "cell", "block", F.lit(False).alias("visiting"), "ball", F.col("cell").alias("home"), "centre", "radius",
        "total", "visits")
    blocks = blocked.where("blocks > 1").groupBy("cell").agg(F.max("blocks").alias("blocks"))
    visitors = balls.select(
        F.explode("visits").alias("cell"), "ball", F.col("cell").alias("home"), "centre", "radius", "total").join(
        F.broadcast(blocks), "cell", "left").select(
        "cell", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"),
        F.lit(True).alias("visiting"), "ball", "home", "centre", "radius", "total",
        F.lit(None).cast("array<int>").alias("visits"))
    met = staged(home.unionByName(visitors).repartition("cell", "block").sortWithinPartitions(
        "cell", "block", "visiting", "ball").mapInArrow(_met(float(np.arccos(limit))), FOUND), "met_balls")
    members = balls.select("ball", "total", F.explode("members").alias("rep"))
    unsure = met.where(F.col("kind") == OPEN).select("u", "v")
    sides = unsure.select("u", "v", F.col("u").alias("ball")).unionByName(
        unsure.select("u", "v", F.col("v").alias("ball")))
    exact = staged(sides.join(members.select("ball", "rep"), "ball").join(reps, "rep").repartition(
        "u", "v").sortWithinPartitions("u", "v").mapInArrow(_verified(limit, shape.size), FOUND), "verified")
    of_balls = met.where(F.col("kind") == COUNT).groupBy("u").agg(F.sum("links").alias("ball_links"))
    of_reps = exact.where(F.col("kind") == COUNT).groupBy("u").agg(F.sum("links").alias("own_links"))
    edges = met.where(F.col("kind") == EDGE).select("u", "v").unionByName(
        exact.where(F.col("kind") == EDGE).select("u", "v"))
    joined = components(edges).select(F.col("node").alias("ball"), "component")
    zero = F.lit(0)
    known = staged(
        members.join(of_balls.withColumnRenamed("u", "ball"), "ball", "left").join(joined, "ball", "left")
        .join(of_reps.withColumnRenamed("u", "rep"), "rep", "left").join(groups, "rep").select(
            "key_a", "key_b", "least", F.coalesce("component", "ball").alias("component"),
            (F.col("total") - 1 + F.coalesce("ball_links", zero) + F.coalesce("own_links", zero)).alias("n_links")),
        "links_of_vectors")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(least, "component").select("key_a", "key_b", "n_links", "component_id")
    return rows.drop("embedding").join(named, ["key_a", "key_b"], "left").select(
        "vec_id", F.coalesce("n_links", zero).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
