from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import xxhash

from fleetlake.llm import simhash
from fleetlake.llm.common import table
from fleetlake.llm.components import components
from fleetlake.llm.queries import QUERIES

DOCS = "doc_id long, text string, fingerprint string, mark string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    """Node to smallest node of its component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5])
@pytest.mark.parametrize("at_once, rows", [(4 * 2**20, 10**6), (500, 40)])
def test_links_connect_what_is_near(spark, monkeypatch, distance, at_once, rows):
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", at_once if distance < 3 else max(at_once, 20_000))
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows if distance < 3 else 10**6)
    rng = random.Random(distance)
    values = {0, 2**64 - 1}
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(4):
            values.add(value)
            for b in rng.sample(range(64), rng.choice((1, distance, distance + 1, 2))):
                value ^= 1 << b
    near = brute_components(sorted(map(signed, values)), lambda a, b: (a ^ b).bit_count() <= distance if a >= 0 <= b else ((a ^ b) % 2**64).bit_count() <= distance)
    distinct = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    edges = simhash.links(distinct, distance)
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 2**6 for r in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {v: roots.get(v, v) for v in near} == near


def test_components_of_chains_stars_and_cliques(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(i, j) for i in range(200, 215) for j in range(200, i)]
    edges += [(500, 500), (159, 300), (300, 159)]
    rng.shuffle(edges)
    nodes = {n for e in edges for n in e}
    pairs = {frozenset(e) for e in edges}
    expected = brute_components(sorted(nodes), lambda a, b: frozenset((a, b)) in pairs)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: r for n, r in expected.items() if n != r}


def documents():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = rng.choices(words, k=rng.choice((2, 3, 4, 5, 200)))
        rows.append((i, " ".join(text), "x", "y"))
        if len(text) == 200:
            text[rng.randrange(200)] = "Changed"
            rows.append((1000 - i, "\n".join(text).upper(), "x", "y"))
    rows += [(2000, None, "x", "y"), (2001, "", "x", "y"), (1999, " \t ", "x", "y"), rows[4], rows[4], (None, rows[7][1], "x", "y"), (None, "alone with no id at all", "x", "y"), (None, "another one without any id", "x", "y")]
    rows += [(4, "another text of an id that is there " * 40, "x", "y"), (3000, "very long " * 40_000, "x", "y")]
    return rows


def test_documents_against_brute_force(spark):
    rows = documents()
    prints = {r[1]: brute_fingerprint(r[1]) for r in rows}
    root = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, text, *_ in rows:
        key = root[prints[text]]
        least[key] = min((x for x in (i, least.get(key)) if x is not None), default=None)
    out = simhash.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    found = Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in out)
    assert found == Counter((i, prints[t], least[root[prints[t]]]) for i, t, *_ in rows)

    kept = simhash.one_of_each(spark.createDataFrame(rows, DOCS).repartition(3))
    assert kept.columns == ["doc_id", "text", "fingerprint", "mark"]
    kept = kept.collect()
    assert sorted(root[prints[r.text]] for r in kept) == sorted(set(root.values()))
    assert all(r.doc_id == least[root[prints[r.text]]] for r in kept)


def test_query_against_brute_force(spark):
    from conftest import SF_DIR

    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    prints = {i: brute_fingerprint(t) for i, t in rows}
    root = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, _ in rows:
        least[root[prints[i]]] = min(i, least.get(root[prints[i]], i))
    out = QUERIES["op4_simhash"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out} == {(i, f"{p:016x}", least[root[p]]) for i, p in prints.items()}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(docs).collect() == [] and simhash.one_of_each(docs).collect() == []
