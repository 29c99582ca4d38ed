"""The set join, the vector codes and the alignment against brute force; nulls, empty texts and tables, ties, repeats, clashing names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm import alignment, connect, setjoin, simhash, similar, vectorcodes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BIG = 2**60


def shingles(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < 3 else [tuple(words[i : i + 3]) for i in range(len(words) - 2)])


def brute_join(rows):
    sets = [shingles(t) for _, t in rows]
    nodes = sorted({s for s in sets if s}, key=len)
    root = {s: s for s in nodes}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    links = 0
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if 10 * len(a) < 9 * len(b):
                break
            if 100 * len(a & b) >= 90 * len(a | b):
                root[find(a)], links = find(b), links + 1
    least = {}
    for (k, _), s in zip(rows, sets, strict=True):
        if s and k is not None:
            least[find(s)] = min(k, least.get(find(s), k))
    return sorted(repr((k, len(s), least.get(find(s)) if s else k)) for (k, _), s in zip(rows, sets, strict=True)), links


def near_copies(rnd, sizes, copies):
    out = []
    for size in sizes:
        words = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            x = list(words)
            for _ in range(rnd.randrange(max(2, size // 12))):
                at, kind = rnd.randrange(len(x)), rnd.randrange(3)
                x[at : at + (kind != 1)] = [f"z{rnd.randrange(10**6)}"] if kind < 2 or len(x) == 1 else []
            out.append(" ".join(x))
    return out


def test_set_join(spark):
    rnd = random.Random(4)
    rows = [(None, None), (1, ""), (2, "  \n"), (3, "a b"), (4, "A  b"), (5, "one"), (5, "one"), (None, "one"), (7, "x " * 3000), (BIG + 1, "p q r s"), (BIG + 2, "p q r t")]
    quoted = [f"b{i}" for i in range(40)]
    texts = near_copies(rnd, [3, 8, 11, 12, 13, 20, 21, 22, 30, 39, 60, 120, 300], 8) + [" ".join(quoted + [f"q{rnd.randrange(30)}" for _ in range(3)]) for _ in range(120)]
    rows += [(10 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N_Shingles", F.lit(1))
    want, links = brute_join(rows)
    assert sorted(repr(tuple(r)) for r in setjoin.joined_sets(df).collect()) == want and links > 300
    assert setjoin.joined_sets(df.limit(0)).count() == 0 == setjoin.joined_sets(df.limit(0)).where("component_id = 1").count()


def test_sets_of_candidates_alone(spark, monkeypatch):
    """Texts that share index entries but, by their sketches, cannot be similar are not made sets again; a tie at the bound is a link."""
    rnd, asked = random.Random(9), []
    own = lambda i, n: [f"o{i}x{j}" for j in range(n)]
    rows = [(i, " ".join([f"b{j}" for j in range(40)] + own(i, 20))) for i in range(60)]
    long = own("long", 97)
    rows += [(100, " ".join(long)), (101, " ".join(long[:92] + own("tie", 5))), (102, " ".join(long[:91] + own("less", 6)))]
    rows += [(200 + i, t) for i, t in enumerate(near_copies(rnd, [60, 80, 100], 1))]
    connected = setjoin.connected

    def watched(*given):
        *first, sets_of, similarity = given
        return connected(*first, lambda nodes: asked.append({r.node for r in nodes.select("node").collect()}) or sets_of(nodes), similarity)

    monkeypatch.setattr(setjoin, "connected", watched)
    want, _ = brute_join(rows)
    got = setjoin.joined_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == want and "(101, 95, 100)" in want and "(102, 95, 102)" in want
    assert 0 < len(set().union(*asked)) < 25


def test_pairs_of_blocks(spark):
    """A large group that is one component goes once to each block of the others, not to each of its own; every pair of different roots is in one group."""
    def dealt(roots, most=10**9):
        placed = [(key, node, root, 5) for key, own in roots.items() for node, root in enumerate(own)]
        rows = similar.block_pairs(spark.createDataFrame(placed, "key long, node long, root long, size long"), spark.createDataFrame([(i, -i) for i in range(400)], "node long, x long"), most, 20).collect()
        groups = {}
        for r in rows:
            assert r.x == -r.node and r.block in (r.low, r.high) and r.root == roots[r.key][r.node]
            groups.setdefault((r.key, r.low, r.high), []).append((r.block, r.node, r.root))
        met = Counter()
        for (key, low, high), own in groups.items():
            met.update((key, min(i, j), max(i, j)) for at, (a, i, x) in enumerate(own) for b, j, y in own[at + 1 :] if x != y and (low == high or a != b))
        assert met == Counter((key, i, j) for key, own in roots.items() for i, x in enumerate(own) for j in range(i + 1, len(own)) if own[j] != x)
        return Counter(r.key for r in rows), max(map(len, groups.values()))

    sizes, most = dealt({1: [7] * 390 + list(range(100, 110)), 2: [3] * 50, 3: [1, 2, 2], 4: list(range(90)), 5: [1, 2] * 60})
    assert sizes[1] == 390 + 10 * 21 and 2 not in sizes and sizes[3] == 3 and sizes[4] == 90 * 5 and most < 80
    assert dealt({1: [7] * 195 + [8] * 5})[0][1] == 195 + 5 * 11
    assert dealt({1: [7] * 30 + [8]}, 50)[0][1] == 31 + 3


def test_large_group_joined(spark, monkeypatch):
    """Blocks of few members and rounds that take what is left from the round before give what all pairs give."""
    rnd = random.Random(12)
    base = [f"c{i}" for i in range(60)]
    texts = [" ".join(base[:at] + [f"y{rnd.randrange(10**6)}"] + base[at + 1 :]) for at in (rnd.randrange(60) for _ in range(150))]
    texts += [" ".join(base[:30] + [f"o{i}x{j}" for j in range(30 + i % 4)]) for i in range(80)] + near_copies(rnd, [40, 60, 90], 12)
    rows = list(enumerate(texts))
    want, _ = brute_join(rows)
    for module in (connect, similar):
        monkeypatch.setattr(module, "BLOCK_MEMBERS", 5)
    got = setjoin.joined_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_schemes():
    """Any two sizes that may be linked share a scheme, and the smaller one's budget covers what they may differ in."""
    schemes = setjoin.Schemes(9, 10)
    for r in range(1, 700):
        for s in range(r, r * 10 // 9 + 1):
            shared = set(schemes.of(r)) & set(schemes.of(s))
            assert (r + s) // 19 == 0 or shared and schemes.budget(r) > (r + s) // 19
            assert all(schemes.segments(c) >= schemes.budget(s) for c in shared)
    assert all(len(schemes.of(s)) <= 2 for s in range(1, 5000)) and schemes.of(8) == []


def test_pigeonhole(spark):
    """Whatever the order of units, two sets within the smaller one's budget share an entry; segments that all agree in come late."""
    rng, schemes = np.random.default_rng(5), setjoin.Schemes(9, 10)
    for _ in range(200):
        a = rng.integers(-(2**62), 2**62, int(rng.integers(70, 90)))
        b = a
        while 10 * len(np.intersect1d(a, b)) >= 9 * len(np.union1d(a, b)):
            last, b = b, np.concatenate([b[1:], rng.integers(-(2**62), 2**62, int(rng.integers(0, 2)))]) if rng.random() < 0.7 else np.concatenate([b, rng.integers(-(2**62), 2**62, 1)])
        scheme = (set(schemes.of(len(a))) & set(schemes.of(len(last)))).pop()
        segments, found = schemes.segments(scheme), []
        order = [(i, 1) for i in rng.permutation(segments)]
        for i in rng.integers(0, segments, 5):  # some second units early, each after its first
            if (i, 2) not in order:
                order.insert(int(rng.integers(order.index((i, 1)) + 1, len(order) + 1)), (i, 2))
        for x in (a, last):
            units = order[: schemes.budget(len(x))]
            whole = setjoin.entries(x, scheme, segments)
            found.append({*whole[[i for i, u in units if u == 1]].tolist(), *setjoin.less_one(x, scheme, segments, [i for i, u in units if u == 2]).tolist()})
        assert found[0] & found[1]
    shared = spark.createDataFrame([(1, 0, 500), (1, 1, 2)], "scheme int, segment int, n long")
    sets = spark.createDataFrame([(1, 3, 50, 600)], "scheme int, segments int, sets long, size long")
    order = [(r.segment, r.unit) for r in setjoin.ordered_units(shared, sets).orderBy("rank").collect()]
    assert order == [(2, 1), (1, 1), (2, 2), (1, 2), (0, 1), (0, 2)]


def test_sketches():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(-(2**62), 2**62, n))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))], rng.integers(-(2**62), 2**62, int(rng.integers(0, n)))]))
        if similar.is_similar(a, b, 0.8):
            assert connect.may_be_similar(connect.odd_sketch(a), connect.odd_sketch(b), len(a), len(b), 0.8)
    sets = [np.unique(rng.integers(-(2**62), 2**62, int(rng.integers(20, 400)))) for _ in range(40)]
    sets += [np.unique(np.concatenate([x[int(rng.integers(0, 9)) :], rng.integers(-(2**62), 2**62, 2)])) for x in sets for _ in range(2)]
    sketches, sizes, roots = [connect.odd_sketch(x) for x in sets], np.array([len(x) for x in sets]), rng.integers(0, 90, len(sets))
    near = lambda i, j: roots[i] != roots[j] and connect.may_be_similar(sketches[i], sketches[j], sizes[i], sizes[j], 0.8)
    for blocks in (np.zeros(len(sets), int), rng.integers(0, 2, len(sets))):
        two = len(set(blocks)) > 1
        found = connect.nearest(sketches, sizes, roots, blocks, 0.8)
        for i, j in enumerate(found.tolist()):
            others = [k for k in range(len(sets)) if k != i and near(i, k) and not (two and blocks[i] == blocks[k])]
            assert (j < 0) == (not others) and (j < 0 or j in others)


def brute_codes(rows, parts=16, entries=64, rounds=2):
    top = 2**63 - 1
    whole = lambda x: top if x * 256 >= 2.0**63 else -top if x * 256 <= -(2.0**63) else math.floor(x * 256)
    kept = [(k, [whole(x) for x in v], label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d, pad = width // parts, lambda v: v + [0] * (width - len(v))
    books = [[pad(v)[p * d : p * d + d] for _, v, _ in order[:entries]] for p in range(parts)]

    def code(v):
        out, error = [], 0
        for p in range(parts):
            far = [sum((a - b) ** 2 for a, b in zip(pad(v)[p * d : p * d + d], c, strict=True)) for c in books[p]]
            out.append(far.index(min(far)))
            error += min(far)
        return out, error

    for _ in range(rounds):
        codes = [code(v)[0] for _, v, _ in kept]
        for p in range(parts):
            for i in range(len(books[p])):
                mine = [pad(v)[p * d : p * d + d] for (_, v, _), c in zip(kept, codes, strict=True) if c[p] == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    done = [(k, label, *code(v)) for k, v, label in kept]
    labels = Counter()
    for _, label, _, error in done:
        labels[label] += min(error, top)
    return sorted(repr((k, "".join(f"{x:02x}" for x in c), min(e, top), min(labels[label], top), digest)) for k, label, c, e in done)


@pytest.mark.parametrize("width", [16, 32])
def test_vector_codes(spark, width):
    rnd = random.Random(1)
    part = lambda: rnd.choice([rnd.uniform(-1, 1), rnd.choice([0.0, 1.0, -1 / 256, 1e-9])])
    rows = [(i % 70 if i % 9 else None, [part() for _ in range(width)], rnd.choice([None, 1, 2])) for i in range(250)]
    odd = [(5, None, 1), (6, [math.nan] * width, 1), (7, [None] * width, 2), (9, [], 1), (10, [1.5] * 5, 2), (12, [math.inf] * width, 1), (BIG + 1, [0.5] * width, 9), (BIG + 2, [0.5] * width, 9)]
    huge = [(8, [1e30] * (width - 1) + [-1e300], 3), (11, [3e7] * width, None)]
    for data in (rows + odd, rows + odd + huge, odd, rows[:3]):
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("Code", F.lit("x"))
        assert sorted(repr(tuple(r)) for r in vectorcodes.compress(df).collect()) == brute_codes(data)
    assert vectorcodes.compress(df.limit(0)).count() == 0 == vectorcodes.compress(df.where("embedding IS NULL")).count()


def test_screening():
    """Near ties and large numbers: the screen gives what whole numbers give."""
    rng = np.random.default_rng(7)
    for top in (3, 200, 1 << 14, 1 << 24, 1 << 28):
        book = rng.integers(-top, top + 1, (64, 4))
        book[40] = book[3]
        x = np.concatenate([rng.integers(-top, top + 1, (300, 4)), (book[rng.integers(0, 64, 100)] + book[rng.integers(0, 64, 100)]) // 2, book])
        far = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        code, error = vectorcodes.screened(x, book)
        assert (code == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def brute_alignment(rows, path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in signs} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in signs)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    found, counts = [], Counter()
    for k, t in rows:
        ids = (a.encode(f" {t}", add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        spans = []
        for own, of in zip(ids, (lambda i: bytes(byte[c] for c in a.id_to_token(i)), piece), strict=True):
            at, out, joined = 0, [], b""
            for i in own:
                out.append((at, at + len(of(i)), i))
                at, joined = at + len(of(i)), joined + of(i)
            spans.append((out, joined))
        if not t or any(j != f" {t}".encode() for _, j in spans):
            found.append((k, 0, 0, 0, [], ""))
            continue
        (left, _), (right, _) = spans
        links, low = [], 0
        for s, e, i in left:
            while right[low][1] <= s:
                low += 1
            at = low
            while at < len(right) and right[at][0] < e:
                links.append((i, right[at][2]))
                at += 1
        cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        group = lambda side: [[str(i) for s, e, i in side if low < e <= high] for low, high in zip([0, *cuts], cuts, strict=False)]
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(group(left), group(right), strict=True))
        counts.update(links)
        found.append((k, len(left), len(right), len(cuts), links, hashlib.sha256(text.encode()).hexdigest()))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(repr((k, x, y, g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), h)) for k, x, y, g, links, h in found), found


def test_alignment(spark):
    P = pytest.importorskip("public_tokenizers")
    paths, rnd = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")), random.Random(3)
    signs = [*"abcde iostr'\n\t.,!?12|>", "<|endoftext|>", "<s>", "</s>", "<0x41>", "é", "漢", "字", "😀", "▁", "  ", "\x00", "　", "ﬁ", " the ", "ing "]
    rows = [(i, "".join(rnd.choices(signs, k=rnd.choice([1, 5, 40, 800])))) for i in range(50)]
    rows += [(None, None), (None, "a b"), (5, ""), (5, "a b"), (BIG + 1, " x  y"), (BIG + 2, "z" * 3000), (7, "▁a"), (8, "é漢" * 900), (9, "The running dogs, and the others.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N_A", F.lit(1))
    want, found = brute_alignment(rows, *paths)
    assert 3 < sum(n == 0 for _, n, *_ in found) < 40
    for kinds in ({}, {"block": 64, "most_links": 500}, {"block": 1, "most_docs": 3}):  # what is cut where does not matter
        assert sorted(repr(tuple(r)) for r in alignment.align(df, *paths, **kinds).collect()) == want
    groups = alignment.groups(df, *paths, block=64).collect()
    assert len(groups) == sum(f[3] for f in found) and sum(len(r.links) for r in groups) == sum(len(f[4]) for f in found)
    one = sorted((r for r in groups if r.doc_id == BIG + 1), key=lambda r: r.start)
    assert [r.start for r in one] == [0, *[r.stop for r in one[:-1]]] and one[-1].stop == len("  x  y") and all(r.a and r.b and {x.a for x in r.links} == set(range(len(r.a))) for r in one)
    assert alignment.align(df.limit(0), *paths).count() == 0


def test_near_stage_by_positional_bytes(spark):
    """The index by positional bytes of fingerprints proposes pairs of its own, which shingles then verify; bands find what is farther apart."""
    rnd = random.Random(9)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    texts = {1: " ".join(words), 2: " ".join([*words, "more"]), 3: " ".join(f"x{i}" if i % 55 == 20 else w for i, w in enumerate(words)), 4: " ".join(f"v{i}" for i in range(300)), 5: "  ", 6: None, 7: ""}
    nodes = spark.createDataFrame([(k, int(np.uint64(simhash.fingerprint_of(t, 5)).view(np.int64))) for k, t in texts.items()], "node long, fp long")
    bits = lambda a, b: (simhash.fingerprint_of(texts[a], 5) ^ simhash.fingerprint_of(texts[b], 5)).bit_count()
    found = {(r.a, r.b) for r in similar.byte_pairs(nodes).collect()}
    assert found == {(b, a) for a in texts for b in texts if a < b and bits(a, b) <= 2 and not (a, b) == (6, 7)} and (2, 1) in found and (3, 1) not in found
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(map(tuple, similar.similar_groups(df).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (7, 5)]
