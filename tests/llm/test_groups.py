"""SimHash groups, decontamination and spot signatures against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, simhash, spot_signatures
from tests.llm import brute


def test_near_duplicates(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(draw.choice(words) for _ in range(120)) for _ in range(15)]
    texts = [None, "", " \n", "one", "ONE", "one two three", *base, *base[:4]]
    for text in base[:8]:
        parts = text.split()
        for _ in range(3):
            parts[draw.randrange(len(parts))] = draw.choice(words)
            texts.append(" ".join(parts))
    docs = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(None, base[5]), (None, "alone here"), (3, base[6])]
    found = simhash.near_duplicates(brute.table(spark, docs)).collect()
    prints = [brute.fingerprint(t) for _, t in docs]
    expected = sorted((str(i), p, str(c)) for (i, _), p, c in zip(docs, prints, brute.linked([i for i, _ in docs], prints)))
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in found) == expected
    assert len(set(prints)) < len(prints)


@pytest.mark.parametrize("radius", [2, 4])
def test_fingerprint_links_reach_the_radius_and_no_further(spark, radius):
    draw = random.Random(radius)
    prints = {draw.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for flips in (1, 2, 3, 4, 5, 6):
            prints.add(p ^ sum(1 << b for b in draw.sample(range(64), flips)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.link_fingerprints(fps, len(prints), radius)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    ours = {}
    for s in signed:
        ours.setdefault(roots.get(s, s), set()).add(s)
    theirs = {}
    for s, c in zip(signed, brute.linked(signed, prints, radius)):
        theirs.setdefault(c, set()).add(s)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_uneven_buckets_are_halved():
    import numpy as np
    import pandas as pd

    draw = random.Random(1)
    owners = sorted({draw.getrandbits(20) for _ in range(300)})
    group = pd.DataFrame({"fp": np.array(owners, dtype=np.int64), "left": 2})
    whole, halved = simhash._meet(4, 2)(group), simhash._meet(4, 2, limit=5_000)(group)
    parts = []
    for links in (whole, halved):
        parent = {o: o for o in owners}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links.itertuples(index=False):
            parent[find(a)] = find(b)
        parts.append(sorted(sorted(o for o in owners if find(o) == r) for r in {find(o) for o in owners}))
    assert parts[0] == parts[1]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(brute.table(spark, [])).count() == 0


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_contamination(spark, block_words):
    draw = random.Random(9)
    words = ["Ab", "cd", "é", "x1", "the", "of", "zz", "q"]
    line = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [("10", line(9)), ("9", line(7)), ("2", "only two"), ("3", "Solo"), ("4", None), ("5", "?!"), ("2", "only two")]
    items.append(("7", items[0][1].upper()))
    texts = [None, "", "...", line(200), items[0][1], "a " + items[1][1].replace(" ", "--") + " b", "SOLO", "not only Two here " * 3]
    texts += [line(30) + " " + items[0][1] + " " + line(30) for _ in range(4)] + ["y " * 500 + items[1][1]]
    benchmark = spark.createDataFrame(items, "item_id string, text string").withColumn("hits", F.lit(1))
    found = decontamination.find_contamination(brute.table(spark, texts), benchmark, window=5, block_words=block_words)
    columns = decontamination.verdict(F.col("contamination"))
    rows = found.select("doc_id", *[c.alias(n) for n, c in columns.items()], "contamination", "uid").collect()
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in rows}
    assert got == dict(enumerate(brute.contamination(texts, items, 5)))
    whole = next(r for r in rows if r["doc_id"] == 4)
    assert whole["longest_match"] == 9 and whole["uid"] == brute.EXTRA["uid"]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    verdict = decontamination.verdict(F.col("contamination"))["contaminated"]
    docs = brute.table(spark, ["a b", None])
    assert [r[0] for r in decontamination.find_contamination(docs, none).select(verdict).collect()] == [False, False]
    assert decontamination.find_contamination(brute.table(spark, []), some).select(verdict).count() == 0


def test_spot_signatures_compare_with_the_right_neighbour(spark):
    base = "the river runs in a valley of green hills and the town lies on a plain by the sea "
    texts = [(5, base * 3), (3, "le chat est sur la table de bois " * 4), (9, None), (7, ""), (7, "sonne"), (None, "der Hund ist im Haus"), (1, base * 3)]
    for size in (2, 1_000):
        rows = spot_signatures.compare_with_edits(brute.table(spark, texts), rows_in_bucket=size).collect()
        got = {(r["doc_id"], r["n_chars"]): r for r in rows}
        assert len(rows) == len(texts)
        order = [(9, ""), (7, None), (7, None), (5, base * 3), (3, texts[1][1]), (1, base * 3), (None, texts[5][1])]
        five = got[(5, len(base) * 3)]
        third = len(base) * 3 // 3
        edited = (base * 3)[: len(base) * 3 - third] + order[4][1][:third]
        assert five["edited_sha256"] == brute.digest(edited.encode())
        assert five["fingerprint"] == got[(1, len(base) * 3)]["fingerprint"]
        last = got[(None, len(texts[5][1]))]
        assert last["edited_sha256"] == brute.digest(texts[5][1][: len(texts[5][1]) - len(texts[5][1]) // 3].encode())
        assert 0 < five["near_edited"] <= 1 and five["near_next"] == 0


def test_spot_signature_rules(spark):
    rows = spark.createDataFrame([("The cat and the dog of Rome",), ("dog rome",), ("",)], "text string")
    sets = [r[0] for r in rows.select(spot_signatures.signatures(F.col("text"))).collect()]

    def hashes(*texts):
        return spark.range(1).select(F.array_sort(F.array(*[F.xxhash64(F.lit(t)) for t in texts]))).first()[0]

    assert sets == [hashes("cat dog", "dog rome", *"the cat and dog of rome".split()), hashes("dog", "rome"), []]
    spots = [f"the w{i} x{i}" for i in range(9)]
    long = spark.createDataFrame([(" ".join(spots),)], "text string").select(spot_signatures.signatures(F.col("text"))).first()[0]
    assert long == hashes(*[f"w{i} x{i}" for i in range(9)])
    assert spot_signatures.compare_with_edits(brute.table(spark, [])).count() == 0


def test_near_pairs_find_all_similar_sets(spark):
    draw = random.Random(4)
    words = [f"n{i}" for i in range(40)]
    texts = [" ".join(sorted(draw.sample(words, draw.randrange(2, 12)))) for _ in range(40)]
    texts += [" ".join(t.split()[draw.randrange(2) :]) for t in texts] + [t + " n99" for t in texts]
    docs = brute.table(spark, [*texts, texts[0], None])
    sets = {i: frozenset(t.split()) for i, t in enumerate(texts)}
    kept = {}
    for i, s in sets.items():
        kept.setdefault(s, i)
    expected = {
        (a, b)
        for x, a in kept.items()
        for y, b in kept.items()
        if a < b and len(x & y) / len(x | y) >= 0.5
    }
    got = {(r["a"], r["b"]) for r in spot_signatures.near_pairs(docs, at_least=0.5).collect()}
    assert got == expected and expected


def test_likeness_does_not_break_where_spots_become_few(spark):
    names = " ".join(f"name{i}" for i in range(45))
    spots = [f"the w{i} x{i}" for i in range(8)]
    eight, seven = f"{names} " + " ".join(spots), f"{names} " + " ".join(spots[:7])
    docs = brute.table(spark, [(1, eight), (2, seven)])
    chains = [f"w{i} x{i}" for i in range(8)]
    sets = [{*t.split(), *c} for t, c in ((eight, chains), (seven, chains[:7]))]
    expected = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    rows = {r["doc_id"]: r for r in spot_signatures.compare_with_edits(docs).collect()}
    assert expected > 0.9
    assert abs(rows[1]["near_next"] - expected) < 1e-12 and abs(rows[2]["near_next"] - expected) < 1e-12
    pairs = spot_signatures.near_pairs(docs).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(1, 2)] and abs(pairs[0]["similarity"] - expected) < 1e-12
