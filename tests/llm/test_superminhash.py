"""SuperMinHash signatures and the near duplicates they find, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import jaccard, superminhash, superminhash_query  # noqa: F401 - registers the query
from tillmark.llm.registry import QUERIES
from tillmark.llm.stars import linked_pairs, star_links
from tillmark.llm.superminhash import COMPONENTS, digest, estimate, near_duplicates, signatures

from .conftest import SF
from .test_jaccard import corpus, found, plain_words


def plain_set(text):
    words = plain_words(text)
    if len(words) < 2:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:]))


def plain(pairs):
    """(doc_id, set size, component, kept) of each row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    rows = ((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(pairs))
    return sorted(((*r, r[0] is not None and r[0] == r[2]) for r in rows), key=repr)


def random_set(rng, size):
    return np.unique(rng.integers(0, 1 << 63, size, np.uint64))


def plain_signature(own, m):
    """The same values, element by element and without stopping early."""
    from tillmark.llm.superminhash import _FRACTION, _STEP, _mix

    values = [(1 << 64) - 1] * m
    for d in own.tolist():
        one = np.array([d], np.uint64)
        at = int(_mix(one ^ np.uint64(0x5851F42D4C957F2D))[0]) % m
        stride = int(_mix(one ^ np.uint64(0x14057B7EF767814F))[0]) % (m - 1) + 1
        for rank in range(m):
            fraction = int(_mix(one + np.uint64(rank * _STEP & (1 << 64) - 1))[0]) >> 64 - _FRACTION
            values[at] = min(values[at], rank << _FRACTION | fraction)
            at = (at + stride) % m
    return values


def test_stopping_early_changes_nothing():
    rng = np.random.default_rng(1)
    sets = [random_set(rng, n) for n in (1, 2, 7, 60, 400, 0, 3000)]
    got = signatures(sets, 31)
    assert [row.tolist() for row in got] == [plain_signature(s, 31) for s in sets]


def test_an_element_takes_every_rank_once():
    one = signatures([np.array([12345], np.uint64)], 31)[0] >> np.uint64(54)
    assert sorted(one.tolist()) == list(range(31))


def test_estimates_are_right_and_vary_less_than_independent_minima():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(150):
        both, x, y = random_set(rng, 120), random_set(rng, 30), random_set(rng, 30)
        a, b = np.unique(np.concatenate([both, x])), np.unique(np.concatenate([both, y]))
        sa, sb = signatures([a, b])
        errors.append(estimate(sa, sb) - 120 / 180)
    independent = (2 / 3 * 1 / 3 / COMPONENTS) ** 0.5
    assert abs(np.mean(errors)) < 4 * independent / 150**0.5
    assert np.std(errors) < 0.9 * independent


@pytest.mark.parametrize("seed", [3, 4])
def test_finds_the_links_of_all_pairs(spark, documents, seed):
    pairs = corpus(seed, 160)
    random.Random(seed).shuffle(pairs)
    assert found(near_duplicates(documents(pairs=pairs).repartition(5))) == plain(pairs)


def test_query(spark, given):
    assert found(QUERIES["op11_superminhash"](spark, SF)) == plain(list(given.items()))


def test_odd_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    pairs = [(4, text), (4, text + " x"), (9, text.upper()), (2, "other words"), (4, "other words"), (None, "lone one")]
    pairs += [(11, None), (11, ""), (12, " \n"), (13, "z " * 200_000), (14, "z " * 6), (None, text), (3, "B"), (5, "b")]
    pairs += [(20, " ".join(str(i) for i in range(100_000)))]
    docs = documents(pairs=pairs).withColumns({"class": F.lit("clash"), "row": F.lit(None).cast("int"), "digest": F.lit(1)})
    assert found(near_duplicates(docs)) == plain(pairs)
    assert near_duplicates(documents()).count() == 0
    assert found(near_duplicates(documents([None, ""]))) == [(0, 0, 0, True), (1, 0, 1, True)]


def family(rng, base, size, edits, low=0):
    """Sets around a base with a few elements exchanged."""
    out = []
    for _ in range(size):
        own = set(base)
        for _ in range(rng.randint(low, edits)):
            own.discard(rng.choice(base))
            own.add(rng.randrange(1 << 62))
        out.append(own)
    return out


@pytest.mark.parametrize("seed, p, q", [(1, 4, 5), (2, 3, 4), (3, 4, 5)])
def test_stars_connect_what_all_pairs_connect(spark, tmp_path, seed, p, q):
    rng = random.Random(seed)
    base = [rng.randrange(1 << 62) for _ in range(100)]
    other = base[:70] + [rng.randrange(1 << 62) for _ in range(30)]
    sets = family(rng, base, 40, 9) + family(rng, base, 60, 16, 10) + family(rng, other, 40, 14)
    # Outsiders that differ from the others alike.
    turned = [rng.randrange(1 << 62) for _ in range(16)]
    sets += family(rng, base[16:] + turned, 25, 6) + [set(base[: rng.randint(40, 100)]) for _ in range(15)]
    rng.shuffle(sets)
    edges = [(0, i) for i in range(1, len(sets))] + [(7, i) for i in range(8, 60)]
    found = star_links(
        spark.createDataFrame(edges, "leader long, class long"),
        spark.createDataFrame([(i, np.array(sorted(s), "<u8").tobytes()) for i, s in enumerate(sets)], "class long, set binary"),
        p, q, str(tmp_path / "stars"),
    )
    root, all_pairs = list(range(len(sets))), list(range(len(sets)))

    def find(root, i):
        while root[i] != i:
            i = root[i]
        return i

    def like(i, j):
        return q * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j])

    for r in found.collect():
        assert like(r.a, r.b)
        root[find(root, r.a)] = find(root, r.b)
    for i in range(len(sets)):
        for j in range(i):
            if like(i, j):
                all_pairs[find(all_pairs, i)] = find(all_pairs, j)
    named = [{tuple(sorted(j for j in range(len(sets)) if find(r, j) == find(r, i))) for i in range(len(sets))} for r in (root, all_pairs)]
    assert named[0] == named[1]
    assert 1 < len(named[0]) < len(sets)


@pytest.mark.parametrize("module", [superminhash, jaccard])
def test_comparing_sets_does_not_shuffle_them_again(spark, documents, monkeypatch, module):
    seen = []
    monkeypatch.setattr(module, "star_links", lambda *given: seen.append(given[:2]) or star_links(*given))
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join([*words[:i], "new", *words[i + 1 :]]) for i in range(0, 120, 10)]
    assert module.near_duplicates(documents(texts)).where("component_id = 0").count() == len(texts)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = linked_pairs(*seen[0], 4, 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The sets of the classes, and those of their leaders.
    assert plan.count("Bucketed: true") == 2


def test_digests_tell_sets_apart():
    assert digest(np.empty(0, np.uint64)) is None
    assert digest(np.array([1], np.uint64)) != digest(np.array([2], np.uint64))


def test_entries_of_buckets_are_dealt_once(spark, documents, monkeypatch):
    frames, before = {}, superminhash.written

    def written(df, path, **options):
        frames[path.rsplit("/", 1)[1]] = df
        return before(df, path, **options)

    monkeypatch.setattr(superminhash, "written", written)
    pairs = corpus(3)
    assert found(near_duplicates(documents(pairs=pairs))) == plain(pairs)
    plan = frames["stars"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(buckets") == 1
