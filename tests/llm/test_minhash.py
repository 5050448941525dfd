"""Near-duplicates against all pairs compared."""

import random

from gridloom.llm import minhash as M


def brute(rows, level=85):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(frozenset(grams))
    known = [(i, s) for i, every in sets.items() if i is not None for s in every]
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(known)):
        for b in range(a):
            (i, s), (j, t) = known[a], known[b]
            both = len(s & t)
            if s and t and 100 * both >= level * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = len({tuple(w[k : k + 5]) for k in range(len(w) - 4)}) if len(w) >= 5 else int(bool(w))
        c = None if i is None else find(i)
        yield str((i, n, c, c == i))


def compare(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(str(tuple(r)) for r in M.near_duplicates(docs, **options).collect()) == sorted(brute(rows))


def test_odd_rows(docs, nothing):
    compare(docs)
    assert M.near_duplicates(nothing).count() == 0


def test_sample(sample):
    compare(sample)


def test_families_with_chains_and_shared_passages(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for family in range(6):
        text = [rng.choice(words) for _ in range(rng.choice([40, 120, 300]))] + passage
        rng.shuffle(text[:10])
        for copy in range(25):
            own = list(text)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
            if rng.random() < 0.3:
                text = own
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(docs)
    compare(docs, side=4)


def test_an_id_on_two_texts_has_the_links_of_both(spark):
    rng = random.Random(7)
    a, b, c, d = ([rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(120)] for _ in range(4))
    near = lambda words, k: " ".join([*words[:-1], f"other{k}"])
    rows = [(7, " ".join(a)), (7, " ".join(b)), (8, near(a, 1)), (9, near(b, 1)), (9, near(b, 2)), (20, " ".join(c)), (20, " ".join(d)), (3, near(c, 1)), (20, " ")]
    # The class of a text has a smaller id than the row that repeats another.
    rows += [(5, " ".join(b)), (30, near(d, 1)), (30, near(d, 1)), (31, ""), (None, " ".join(c)), (None, None)]
    for _ in range(3):
        rng.shuffle(rows)
        compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20) if i != 9] + [(30, 30)], "a long, b long")
    got = {r.id: r.component for r in M.components(links).collect()}
    assert got == {i: 0 if i < 10 else 10 for i in range(21)}
    assert M.components(links.where("a < 0")).count() == 0


def test_a_class_is_missed_rarely():
    import math

    missed = sum(math.comb(48, i) * 0.85**i * 0.15 ** (48 - i) for i in range(M.MATCHES))
    assert missed < 1e-4
