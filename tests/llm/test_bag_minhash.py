import math
import random
from itertools import combinations

import numpy as np

from catalogflow.llm import bag_minhash
from catalogflow.llm.components import components


def brute(rows):
    """(id, least id of the class) by all pairs."""
    bags = [bag_minhash.bag_of(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if bags[i] and bags[j] and bag_minhash.overlap(bags[i], bags[j]) >= 0.8:
            root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted(((doc, least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def cases():
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdefghij", k=4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(r.randint(5, 250))]
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for at in r.sample(range(len(base)), min(len(base), r.choice((0, 0, 1, 2, 4)))):
                copy[at] = word()
            rows.append((r.randint(0, 10**6), " ".join(copy)))
    # A drifting chain: neighbours are linked, the ends are not.
    chain = [word() for _ in range(300)]
    for i in range(10):
        chain[i * 30 : i * 30 + 12] = [word() for _ in range(12)]
        rows.append((2 * 10**6 + i, " ".join(chain)))
    # Equal sets of runs with other counts.
    rows += [(3 * 10**6, "p q r s t " * 40), (3 * 10**6 + 1, "p q r s t " * 45), (3 * 10**6 + 2, "p q r s t " * 90)]
    return rows


def test_equals_brute_force(spark, rows):
    data = cases()
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    assert rows(bag_minhash.classes(docs), "doc_id", "class_id") == brute(data)


def open_pairs(spark, nodes, d, buckets=("b",), root=None):
    """What _rest pairs among ``nodes``, given their distances to the hub and their roots."""
    hub, root = (False, 0, 0), root or {}
    kind = "struct<none: boolean, id: bigint, v: bigint>"
    node = lambda i: (False, i, 0)
    members = [(b, hub, node(i), n) for b in buckets for i, n in [(0, 100), *nodes.items()]]
    rest = bag_minhash._rest(
        spark.createDataFrame(members, f"bucket string, hub {kind}, node {kind}, n int"),
        spark.createDataFrame([(hub, node(i), 1 - x) for i, x in d.items()], f"a {kind}, b {kind}, s double"),
        spark.createDataFrame([(node(i), node(r)) for i, r in root.items()], f"node {kind}, root {kind}"),
        spark.createDataFrame(
            [(node(i), [0] * 16) for i in (0, *nodes)],
            f"k_node {kind}, parity array<bigint>",
        ),
        0.8,
    )
    return {(r.a.id, r.b.id) for r in rest.collect()}


def test_open_members_meet_in_a_single_bucket(spark):
    # 4 is ruled out by its size, 5 by its distance to the hub.
    nodes, d = {1: 100, 2: 100, 3: 100, 4: 70, 5: 100}, {1: 0.6, 2: 0.6, 3: 0.7, 4: 0.6, 5: 0.95}
    assert open_pairs(spark, nodes, d) == {(1, 2), (1, 3), (2, 3)}
    assert open_pairs(spark, nodes, d, ("b", "c", "e")) == {(1, 2), (1, 3), (2, 3)}


def test_open_members_meet_a_chain_of_the_hub(spark):
    # h-2 and 2-1 are linked, so 1 is of the hub's component at 0.4; 3 at 0.45 may be linked to 1.
    found = open_pairs(spark, {1: 100, 2: 100, 3: 100}, {1: 0.4, 2: 0.2, 3: 0.45}, root={0: 0, 1: 0, 2: 0})
    assert found == {(1, 3)}


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**63, 500).astype(np.uint64)
    a = np.sort(x[:400]), r.integers(1, 9, 400)
    b = np.sort(x[100:]), r.integers(1, 9, 400)
    counts = [dict(zip(h.tolist(), c.tolist())) for h, c in (a, b)]
    keys = set(counts[0]) | set(counts[1])
    least, most = (
        sum(f(counts[0].get(k, 0), counts[1].get(k, 0)) for k in keys) for f in (min, max)
    )
    s = bag_minhash.signatures([a, b], 4000)
    assert abs((s[0] == s[1]).mean() - least / most) < 0.035


def plain_signature(hashes, counts, m):
    """Point by point in Python integers: the earliest point of each component."""
    whole = (1 << 64) - 1

    def mix(z):
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & whole
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & whole
        return z ^ (z >> 31)

    uniform = lambda z: ((z >> 11) + 0.5) / (1 << 53)
    limit, best = 100 / sum(counts), {}
    for element, count in zip(hashes, counts):
        low, width = 0, 1
        while low < count:
            level, time, step = mix(element ^ mix(2 * low + 1)), 0.0, 0
            while True:
                step += 1
                point = mix((level + step * int(bag_minhash._POINT)) & whole)
                time -= math.log(uniform(mix(point ^ int(bag_minhash._GAP)))) / (width * m)
                if time > limit:
                    break
                place = mix(point ^ int(bag_minhash._PLACE))
                if low + width * uniform(mix(place)) < count:
                    best[place % m] = min(best.get(place % m, (math.inf, 0)), (time, point))
            low, width = low + width, width if low == 0 else 2 * width
    return [best[i][1] for i in range(m)]


def odd_bags():
    """More bags than one group: a single run, few runs, none, many, and high counts."""
    r = np.random.default_rng(3)
    sizes = [1, 2, 0, 5, 40, 600, 3] * 12
    return [(r.integers(0, 2**63, n).astype(np.uint64), r.integers(1, 1 + 9 ** (i % 5), n)) for i, n in enumerate(sizes)]


def test_signatures_equal_the_plain_ones():
    bags = odd_bags()
    found = bag_minhash.signatures(bags, 24)
    for got, (hashes, counts) in zip(found.tolist(), bags):
        want = plain_signature(hashes.tolist(), counts.tolist(), 24) if len(hashes) else [0] * 24
        assert got == want


def test_short_texts_take_few_array_steps(monkeypatch):
    # A run of a short text has hundreds of points; made one after another, most arrays hold a few.
    calls, mixed = [], bag_minhash.mixed
    monkeypatch.setattr(bag_minhash, "mixed", lambda keys: (calls.append(1), mixed(keys))[1])
    bag_minhash.signatures([(np.arange(1, n + 1, dtype=np.uint64), np.ones(n, np.int64)) for n in (1, 3, 900)], 192)
    assert len(calls) < 200


def test_parities_see_every_occurrence_and_stay_a_bound():
    unequal = lambda x, y: int(np.unpackbits((bag_minhash.parities(*x) ^ bag_minhash.parities(*y)).view(np.uint8)).sum())
    r = np.random.default_rng(5)
    runs = r.integers(0, 2**63, 60).astype(np.uint64)
    # Counts that differ by two have equal parities as wholes.
    assert unequal((runs, np.full(60, 1)), (runs, np.full(60, 3))) > 90
    for n in (0, 1, 60):
        a, b = r.integers(1, 9, n), r.integers(1, 9, n)
        assert unequal((runs[:n], a), (runs[:n], b)) <= np.abs(a - b).sum()
        assert unequal((runs[:n], a), (runs[:0], a[:0])) <= a.sum()
        assert unequal((runs[:n], a), (runs[:n][::-1], a[::-1])) == 0


def test_keep_first(odd, empty, spark):
    kept = bag_minhash.keep_first(odd)
    assert kept.columns == odd.columns
    got = sorted((r.doc_id or 0 for r in kept.collect()))
    # Of rows 4 and 4 one stays, and 6 stays for the row with a null id.
    assert got == [1, 2, 3, 4, 5, 6, 7, 8]
    assert bag_minhash.keep_first(empty).count() == 0
    assert bag_minhash.classes(empty).count() == 0


def test_components_of_a_long_path(spark, rows):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (None, 5)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert rows(found, "node", "root") == sorted(
        [(i, 0) for i in range(61)] + [(100, 100), (200, 100)], key=repr
    )
