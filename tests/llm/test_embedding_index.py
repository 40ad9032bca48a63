"""Linked vectors against all pairs."""

import numpy as np
import pytest

from ratesmith.llm import embedding_index as ei

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(ids, vectors, limit=0.95):
    """vec_id, n_links, component_id, kept of every row; vectors may be None or of any length."""
    size = max([len(v) for v in vectors if v is not None] + [1])
    unit, usable = np.zeros((len(ids), size)), np.zeros(len(ids), bool)
    for at, vector in enumerate(vectors):
        if vector is None or any(x is None for x in vector) or not len(vector):
            continue
        values = np.array(vector, np.float32).astype(float)
        if np.isfinite(values).all() and values.any():
            unit[at, :len(values)] = values / np.linalg.norm(values)
            usable[at] = True
    linked = (unit @ unit.T >= limit) & usable & usable[:, None]
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        least = np.where(linked, label, len(ids)).min(1, initial=len(ids))
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    names = {}
    for own, name in zip(label, ids):
        if name is not None:
            names[own] = min(names.get(own, name), name)
    return sorted(((name, int(n), names.get(own, name), name == names.get(own, name))
                   for name, n, own in zip(ids, linked.sum(1), label)), key=repr)


def found(spark, ids, vectors, kind="float", **options):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids, vectors)]
    frame = spark.createDataFrame(rows, SCHEMA.replace("float", kind)).repartition(4)
    return sorted(map(tuple, ei.linked_vectors(frame, **options).collect()), key=repr)


def near(draw, centre, cosine, n):
    """Vectors at a cosine from a centre, in random directions."""
    noise = draw.normal(size=(n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return cosine * centre + (1 - cosine**2) ** 0.5 * noise


def test_groups_of_every_kind(spark):
    draw = np.random.default_rng(5)
    unit = lambda n, d=32: (lambda v: v / np.linalg.norm(v, axis=1)[:, None])(draw.normal(size=(n, d)))
    centres = unit(6)
    parts = [unit(400), near(draw, centres[0], 0.995, 150), near(draw, centres[1], 0.975, 150),
             near(draw, centres[2], 0.96, 60), np.repeat(centres[3:4], 90, 0), near(draw, centres[4], 0.9999, 40) * 7.5]
    # a chain whose ends are far apart
    steps = [centres[5]]
    for _ in range(12):
        steps.append(near(draw, steps[-1], 0.955, 1)[0])
    vectors = np.concatenate([*parts, np.array(steps)])
    ids = draw.permutation(len(vectors)).tolist()
    assert found(spark, ids, vectors) == plain(ids, vectors)


def test_recall_at_the_limit(spark):
    """Pairs at the very limit, the hardest for the index, among unrelated vectors."""
    draw = np.random.default_rng(6)
    base = draw.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    vectors = np.concatenate([base, *[near(draw, v, 0.951, 1) for v in base]])
    links = sum(row[1] for row in found(spark, list(range(3000)), vectors))
    wanted = sum(row[1] for row in plain(list(range(3000)), vectors))
    assert wanted >= 3000 and 0.97 * wanted <= links <= wanted


def test_one_group_in_many_blocks(spark):
    draw = np.random.default_rng(7)
    centre = np.ones(16) / 4
    vectors = near(draw, centre, 0.99, 5000)
    rows = found(spark, list(range(5000)), vectors)
    assert rows == plain(list(range(5000)), vectors)


def test_balls_hold_linked_vectors_only():
    draw = np.random.default_rng(8)
    vectors = np.concatenate([near(draw, np.eye(16)[i], c, 60) for i, c in enumerate((0.999, 0.98, 0.96, 0.9))])
    balls = ei.balls_of(vectors, 0.95)
    assert sorted(at for members, *_ in balls for at in members) == list(range(len(vectors)))
    assert max(len(members) for members, *_ in balls) > 50
    for members, centre, radius in balls:
        own = vectors[members]
        assert (own @ own.T >= 0.95).all()
        assert (np.arccos(np.clip(own @ centre, -1, 1)) <= radius + 1e-6).all()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0, 0, 0], [1, None, 0], [nan, 1, 0], [inf, 0, 0], [1, 0, 0], [2, 0, 0], [1], [1, 0],
               [0, 1, 0], [1, 0, 0], [-0.0, 1, 0], [-1, 0, 0], [3e30, 0, 0]]
    ids = [3, 4, 5, 6, 7, 8, 20, 10, 11, None, 13, 13, 12, 15, 16]
    assert found(spark, ids, vectors, kind) == plain(ids, vectors)


def test_few_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ei.linked_vectors(empty).count() == 0
    assert found(spark, [1], [[0.5]]) == [(1, 0, 1, True)]
    assert found(spark, [2, 1], [None, [0.0]]) == [(1, 0, 1, True), (2, 0, 2, True)]
    extra = spark.createDataFrame([(1, [1.0], 2, 3, "x")], "vec_id long, embedding array<float>, cell int, rep long, row_number string")
    assert ei.linked_vectors(extra).collect()[0].kept
