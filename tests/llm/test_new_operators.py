"""Operators 11 to 13 against brute force, with the odd cases their docstrings define."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from textlab.llm import collocations, context_tree, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(120))
DOCS = "doc_id long, text string, lang string, word string, n long, block long, w1 string"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, "x", 1, 2, "y") for i, t, g in rows], DOCS)


ODD = [
    (0, BASE, "en"),
    (1, BASE.upper() + ". new York, New york; new york", "en"),
    (2, "a b a b a b a b\na b\x0bc a b", "en"),
    (3, None, None),
    (4, "", "de"),
    (5, " \t\n ", "de"),
    (6, "one two", None),
    (7, "one two", "und"),
    (7, "one two", "und"),
    (8, "a b c " * 40, "fr"),
    (9, " ".join(f"z{i % 50}" for i in range(20_000)), "fr"),
    (10, "x" * 5000 + " É été Ünder\x00 ▁ é日本 .. !? a", "en"),
    (None, "no id here", "en"),
]


# --- 11 ------------------------------------------------------------------------------


def codes_by_hand(rows, parts, entries, rounds):
    """Plain integer arithmetic on rows (vec_id, label, vector)."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    if not kept:
        return []
    width = -(-max(len(r[2]) for r in kept) // parts)
    cut = []
    for _, _, v in kept:
        x = [math.floor(256 * c) for c in v] + [0] * (parts * width - len(v))
        cut.append([x[p * width : (p + 1) * width] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = []
    for (i, label, _), x in zip(kept, cut, strict=True):
        best = [nearest(x[p], books[p]) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best)))
    by_label = Counter()
    for _, label, _, e in coded:
        by_label[label] += e
    return [(i, code, e, by_label[label], digest) for i, label, code, e in coded]


def embeddings(spark, rows):
    schema = "vec_id long, label int, embedding array<float>, code string, _salt int, part int"
    return spark.createDataFrame([(i, lab, v, "x", 1, 2) for i, lab, v in rows], schema)


def as_floats(spark, rows):
    import numpy as np

    return [(i, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]


@pytest.mark.parametrize("width", [1, 3, 4, 7])
def test_vector_codes(spark, width):
    rng = random.Random(width)
    cfg = vector_codes.VectorCodes(parts=4, entries=6, rounds=2)
    rows = [(i, rng.choice([1, 2, None]), [rng.gauss(0, 0.02) for _ in range(4 * width)]) for i in range(150)]
    rows += [(i, 1, rows[3][2]) for i in range(150, 200)]  # copies: ties everywhere
    rows = as_floats(spark, rows)
    got = sorted(map(tuple, vector_codes.compress(embeddings(spark, rows).repartition(5), cfg).collect()))
    assert got == sorted(codes_by_hand(rows, 4, 6, 2))


def test_vector_codes_odd_rows(spark):
    cfg = vector_codes.VectorCodes(parts=4, entries=6)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, None), (2, 1, [nan] * 8), (3, 1, [inf] * 8), (4, 1, [None] * 8), (5, None, [0.5] * 8), (5, None, [0.5] * 8),
        (5, 2, [0.25] * 8), (None, 2, [-0.3] * 8), (None, None, [-0.3] * 8), (6, 2, []), (7, 3, [0.1] * 5), (8, 3, [-0.001] * 8),
    ]
    rows = as_floats(spark, rows)
    got = [tuple(r) for r in vector_codes.compress(embeddings(spark, rows), cfg).collect()]
    want = codes_by_hand(rows, 4, 6, 2)
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 8
    empty = vector_codes.compress(embeddings(spark, rows).limit(0))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    with pytest.raises(Exception, match="scaled size"):
        vector_codes.compress(embeddings(spark, [(1, 1, [1e8] * 16)])).collect()


def test_walsh_hadamard():
    import numpy as np

    for m in (1, 2, 4, 8, 16):
        h = vector_codes.hadamard(m)
        assert (h @ h.T == m * np.eye(m)).all()
        assert [(r[1:] != r[:-1]).sum() for r in h] == list(range(m))


# --- 12 ------------------------------------------------------------------------------


def collocations_by_hand(rows, cfg):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, cfg.max_words + 1):
                f.update((lang, w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    many = {p: c for p, c in f.items() if c >= cfg.min_count and len(p[1]) > 1}
    for (lang, w), a in many.items():
        inside = any(
            g == lang and len(v) > len(w) and b >= a and any(v[i : i + len(w)] == w for i in range(len(v)))
            for (g, v), b in many.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, w[:k]], f[lang, w[k:]]
            cuts.append((math.floor(Fraction(1000 * a * n[lang], left * right)), k, left, right))
        s, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), left, right, n[lang]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, m, -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right, m) in enumerate(sorted(found)[: cfg.top])
    )


@pytest.mark.parametrize("bits", [4, 18])
def test_collocations(spark, bits):
    """With 16 buckets nearly all collide: the counts stay exact."""
    rng = random.Random(bits)
    words = [f"v{i}" for i in range(12)] + ["B", "b", "ß"]
    rows = [
        (i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n"]) for _ in range(rng.randrange(80))),
         rng.choice(["en", "en", "de", None]))
        for i in range(60)
    ]
    cfg = collocations.Collocations(min_count=4, top=25, bucket_bits=bits)
    got = sorted(map(tuple, collocations.mine(documents(spark, rows + ODD).repartition(3), cfg).collect()))
    assert got == collocations_by_hand(rows + ODD, cfg)


def test_collocations_cut_long_texts(spark, monkeypatch):
    """Pieces of a long text overlap by what continues a window; nothing counts twice."""
    monkeypatch.setattr(collocations, "STEP_WORDS", 7)
    monkeypatch.setattr(collocations, "STEP_BYTES", 40)
    rows = [(0, "a b c d e f " * 30 + ". b c b c d", "en"), (1, "a b c d e f", "en")]
    cfg = collocations.Collocations(min_count=3, bucket_bits=10)
    got = sorted(map(tuple, collocations.mine(documents(spark, rows), cfg).collect()))
    assert got == collocations_by_hand(rows, cfg) and got


def test_collocations_empty(spark):
    got = collocations.mine(documents(spark, []))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0
    assert collocations.mine(documents(spark, [(1, None, None), (2, "", "x")])).count() == 0


# --- 13 ------------------------------------------------------------------------------


def body_of(text):
    return b" ".join(w.encode() for w in WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))) + b"\n"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


class Tree:
    """One decision's context tree, node by node: (context bytes, prefix bits) -> counts."""

    def __init__(self, depth):
        self.depth, self.counts, self.cache = depth, Counter(), {}

    def add(self, body):
        data = b"\n" * self.depth + body
        for i in range(self.depth, len(data)):
            bits = f"{data[i]:08b}"
            for j in range(8):
                for d in range(self.depth + 1):
                    self.counts[data[i - d : i], bits[:j], bits[j]] += 1

    def finish(self):
        self.below = {}
        for c, p, _ in self.counts:
            if c:
                self.below.setdefault((c[1:], p), set()).add(c)

    def log_kt(self, a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def log_w(self, c, p):
        if (c, p) not in self.cache:
            own = self.log_kt(self.counts[c, p, "0"], self.counts[c, p, "1"])
            if len(c) < self.depth:
                under = sum(self.log_w(x, p) for x in self.below.get((c, p), ()))
                top = max(own, under)
                own = top + math.log((math.exp(own - top) + math.exp(under - top)) / 2)
            self.cache[c, p] = own
        return self.cache[c, p]

    def prob(self, context, p, bit):
        """Mixed from the deepest context to the empty one."""
        out = None
        for d in range(self.depth, -1, -1):
            c = context[self.depth - d :]
            a, b = self.counts[c, p, "0"], self.counts[c, p, "1"]
            kt = ((b if bit == "1" else a) + 0.5) / (a + b + 1)
            if out is None:
                out = kt
            else:
                stop = math.exp(self.log_kt(a, b) - math.log(2) - self.log_w(c, p))
                out = stop * kt + (1 - stop) * out
        return out

    def score(self, body):
        data = b"\n" * self.depth + body
        total = 0.0
        for i in range(self.depth, len(data)):
            bits = f"{data[i]:08b}"
            total += sum(math.log10(self.prob(data[i - self.depth : i], bits[:j], bits[j])) for j in range(8))
        return total


def scores_by_hand(rows, depth):
    tree, c = Tree(depth), Counter()
    tokens = {k: [*WORD.findall(body_of(t).decode()), "\n"] for k, (_, t) in enumerate(rows)}
    for k, (i, t) in enumerate(rows):
        if not held(i):
            tree.add(body_of(t))
            c.update(tokens[k])
    tree.finish()
    n, v = sum(c.values()), len(c)
    out = []
    for k, (i, t) in enumerate(rows):
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[k])
        known = sum(c[w] > 0 for w in tokens[k])
        out.append((i, held(i), len(tokens[k]), known, n, base, tree.score(body_of(t))))
    return out


def compare_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:7] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("depth", [3, 5])
def test_context_tree(spark, depth):
    short = [r for r in ODD if r[0] != 9]
    rows = [*short, (11, BASE[:90], "en"), (12, "an other text of a b c " * 3, "en"), (18, "e é E", "de")]
    assert any(held(r[0]) for r in rows)
    got = context_tree.score(documents(spark, rows).repartition(3), context_tree.ContextTree(depth=depth))
    assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    compare_scores(got.collect(), scores_by_hand([r[:2] for r in rows], depth))


def test_context_tree_in_small_steps(spark, monkeypatch):
    """Blocks, steps and subtrees of any size give the same scores."""
    for name, size in (("BLOCK_BYTES", 100), ("STEP_BYTES", 16), ("STEP_WINDOWS", 5)):
        monkeypatch.setattr(context_tree, name, size)
    rows = [(i, " ".join(random.Random(i).choices(["ab", "abc", "b", "É"], k=20)), "en") for i in range(25)]
    got = context_tree.score(documents(spark, rows).repartition(2), context_tree.ContextTree(depth=4))
    compare_scores(got.collect(), scores_by_hand([r[:2] for r in rows], 4))


def test_context_tree_without_training_texts(spark):
    only = [(i, "ab c", "en") for i in range(200) if held(i)]
    got = context_tree.score(documents(spark, only)).collect()
    assert len(got) == len(only)
    assert all(r["score"] == pytest.approx(-8 * 5 * math.log10(2)) and r["base_score"] == 0 for r in got)
    assert context_tree.score(documents(spark, [])).count() == 0


def test_context_tree_beats_the_baseline(spark):
    """Held-out texts of the given table cost fewer bits a byte than eight, and learning helps."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = context_tree.score(docs).groupBy("held_out").agg(F.avg("bits_per_byte").alias("b")).collect()
    bits = {r["held_out"]: r["b"] for r in got}
    assert bits[False] < bits[True] < 4
