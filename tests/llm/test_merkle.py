import hashlib
import zlib

import pytest

from corpuskiln.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, low=False):
    i, text, lang, source, n = row
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if low and text is not None else text
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(hashes, fanout):
    """All levels of a tree."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k : k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def others(levels, i, fanout):
    out = []
    for nodes in levels[:-1]:
        at = i - i % fanout
        out += [h for k, h in enumerate(nodes[at : at + fanout], at) if k != i]
        i //= fanout
    return out


def rise(h, levels, i, fanout):
    for nodes in levels[:-1]:
        at = i - i % fanout
        run = nodes[at : at + fanout]
        run[i - at] = h
        h, i = digest("".join(run)), i // fanout
    return h


def brute_force(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, climb([leaf(r) for r in own], fanout)))
    top = climb([t[-1][0] for _, t in trees], fanout)
    out = []
    for no, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            proof = others(levels, i, fanout) + others(top, no, fanout)
            low = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = rise(rise(leaf(r, low), levels, i, fanout), top, no, fanout)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], digest("".join(proof)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, fanout, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 as tree", "2 as idx", "'x' as hash", "3 as n", "4 as row", "5 as siblings")
    out = merkle.prove(merkle.build(merkle.leaves_of(df), "source", "doc_id", fanout), "tampered")
    return sorted(((r["row"]["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in out.collect()), key=str)


def sample(sizes):
    return [(100 * g + i, f"Text {i} é" * (i % 4), "en", name, i) for g, (name, n) in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize(("fanout", "few"), [(2, 1 << 16), (3, 4), (16, 1 << 16)])
def test_equals_brute_force(spark, monkeypatch, fanout, few):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", few)
    rows = sample([("b", 40), ("a", 1), ("é", 17), (None, 5), ("", 16)])
    got = run(spark, rows, fanout)
    assert got == brute_force(rows, fanout)
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_many_groups(spark):
    rows = sample([(f"s{k}", 1 + k % 3) for k in range(40)])
    assert run(spark, rows, 4) == brute_force(rows, 4)


def test_edge_cases(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (1, "A", "en", "s", 1), (1, "A", "en", "s", 1), (1, "B", "en", "s", 1), (-7, "Long " * 50_000, "en", "s", None)]
    assert run(spark, rows, 16, extra=True) == brute_force(rows, 16)
    assert run(spark, rows[:1], 16) == brute_force(rows[:1], 16)
    assert run(spark, [], 16) == []
