"""Each operator against brute force, a library or a round trip, with the odd cases its docstring defines."""

from __future__ import annotations

import base64
import hashlib
import io
import pathlib
import re
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlab.llm import (
    common,
    line_dedup,
    mixing,
    near_dup,
    nearest,
    pieces,
    quality_classifier,
    quality_rules,
    token_counts,
    url_filter,
    warc_zip,
)
from textlab.llm.queries import RULES, tokenizer_path
from textlab.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, word string, _h string, _row string, key string"
BASE = " ".join(f"w{i}" for i in range(120))


def documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, "x", "y", "z", "k") for i, t, s in rows], DOCS)


ODD = [
    (0, BASE, "a"),
    (1, BASE.replace("w7 ", "q7 "), "a"),
    (2, BASE.upper(), "b"),
    (3, None, None),
    (4, "", "b"),
    (5, " \t\n ", "c"),
    (6, "one two", "c"),
    (7, "one two", None),
    (7, "one two", None),
    (8, "a b c " * 40, "a"),
    (9, " ".join(f"z{i}" for i in range(20_000)), "b"),
    (10, "| # $ \x0b x%\ny\ny\n\ny z", "a"),
    (11, "word" * 400 + " é日本\x00 ▁ <s> ", "c"),
    (None, "no id here", "a"),
]


# --- 1 -------------------------------------------------------------------------------


def url_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.pattern) > len(best.pattern):
                best = r
    return host, path, best


def bayes_by_hand(urls, split):
    """Log odds to block of (host, path, rule) by multinomial naive Bayes over what the rules decide."""
    import math

    words = [[*split.get(h, []), *re.findall("[a-z]+", re.sub("[A-Z]+", lambda m: m[0].lower(), p))] for h, p, _ in urls]
    counts, docs = {"block": Counter(), "allow": Counter()}, Counter()
    for w, (_, _, rule) in zip(words, urls, strict=True):
        if rule:
            counts[rule.verdict].update(w)
            docs[rule.verdict] += 1
    vocabulary = set(counts["block"]) | set(counts["allow"])
    odds = {
        w: math.log((counts["block"][w] + 1) / (sum(counts["block"].values()) + len(vocabulary)))
        - math.log((counts["allow"][w] + 1) / (sum(counts["allow"].values()) + len(vocabulary)))
        for w in vocabulary
    }
    prior = math.log((docs["block"] + 1) / (docs["allow"] + 1))
    return [prior + sum(odds.get(x, 0) for x in w) for w in words]


def test_url_rules(spark):
    urls = [
        None, "", "example.com/en/", "http://Example.COM/en/x?q=/fr/", "https://www.example.com/en/1", "x://a.net/fr/",
        "http://net", "http://net/es/#a", "http://com?x", "http://notcom/", "http://b.example.com/de/",
        "http://a/b://c.net/fr/", "http://cheappills.example.org/en/1", "http://casino.org/", "http://quiet.org/en/2",
        "http://" + "q" * 300 + ".org/",
    ]
    html = "<p>cheap pills for quiet people, cheap cheap pills</p>"
    pages = spark.createDataFrame([(i, u, html, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string, _h string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule = url_verdict(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.pattern), u
        if rule:
            assert got[i].verdict == rule.verdict
    want = bayes_by_hand(
        [url_verdict(u) for u in urls],
        {r.host: list(r.words) for r in url_filter.segment_hosts(
            spark.createDataFrame([(url_verdict(u)[0],) for u in urls], "host string").distinct(),
            url_filter.word_counts(pages)).collect()},
    )
    for i, (_, _, rule) in enumerate(map(url_verdict, urls)):
        assert got[i].score == pytest.approx(want[i], abs=1e-9)
        assert rule or got[i].verdict == ("block" if want[i] > 0 else "allow")
    split = url_filter.segment_hosts(
        spark.createDataFrame([("cheappills.org",)], "host string"), url_filter.word_counts(pages)
    ).first()
    assert split.words[:2] == ["cheap", "pills"]
    # three hosts share a label that no text has; a fourth, alone with its label, keeps its letters together
    own = spark.createDataFrame(
        [(i, f"http://{h}/", "cheapzebra.org says cheap", "", "") for i, h in
         enumerate(["a.shared.org", "b.shared.org", "c.shared.org", "cheapzebra.org"])], pages.schema)
    found = url_filter.segment_hosts(
        own.select(F.regexp_extract("url", "//([^/]*)", 1).alias("host")), url_filter.word_counts(own))
    assert {r.host: list(r.words) for r in found.collect()}["cheapzebra.org"] == ["cheap", "zebra", "org"]
    assert {r.host: list(r.words) for r in found.collect()}["a.shared.org"] == ["a", "shared", "org"]
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


# --- 2 -------------------------------------------------------------------------------


def as_unigram(path, to):
    """The model file with its model type set to unigram (field 3 of the trainer part)."""
    with open(path, "rb") as f:
        body = f.read()
    at = body.rindex(b"\x18\x02 \x80")
    with open(to, "wb") as f:
        f.write(body[:at] + b"\x18\x01" + body[at + 2 :])
    return to


def test_pieces_equal_the_library(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    model = pieces.load(tokenizer_path())
    docs = documents(spark, ODD + [(20 + i, t, "a") for i, t in enumerate(["  x   y ", "a\tb\nc", "don't 12345 ...", "ñé ü"])])
    encoded = pieces.encode(docs, model, ("doc_id", "text"))
    rows = pieces.decode(encoded, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r.ids) == lib.encode(r.text or ""), r.text
        assert r.decoded == lib.decode(list(r.ids)) == (r.text or "").replace("▁", " ")
    assert pieces.encode(docs.limit(0), model).count() == 0


def test_decoding_is_one_expression_and_spells_bytes_as_the_library(spark):
    model = pieces.load(tokenizer_path())
    at = {b: i for i, b in reversed(list(enumerate(model.spelled)))}
    piece = {b: model.byte_base + b for b in range(256)}
    lists = [
        [], None, [model.unknown], [piece[b] for b in "é日".encode()], [piece[0xE6], piece[0x97], at[b" the"], piece[0xFF]],
        [at[b" the"], at[b" the"]], [piece[0x20], piece[0x20]], [0, 1, 2],
    ]
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    decoded = pieces.decode(rows, model)
    for r in decoded.collect():
        body = b"".join(model.spelled[i] for i in lists[r.doc_id] or ())
        assert r.decoded == body.removeprefix(b" ").decode("utf-8", "replace")
    # a Python worker of its own beside the encoding one took it over the executor's memory
    assert "Arrow" not in decoded._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_of_mixed_lengths_and_null_ids(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    model = pieces.load(tokenizer_path())
    # short texts, texts of two length classes above, one without a space
    texts = ["one two", "ab cd " * 7000, "x" * 40000, None, "three " * 12000, "one two"]
    rows = [(None if i == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, model).collect()}
    assert got == {(d, tuple(lib.encode(t or ""))) for d, t in rows}


def starts_of(unit, ids, model):
    """Bits of where the pieces of a unit start."""
    out = at = k = 0
    while k < len(ids):
        out |= 1 << at
        if 0 <= ids[k] - model.byte_base < 256:
            k, at = k + len(unit[at].encode()), at + 1
        else:
            k, at = k + 1, at + len(model.spelled[ids[k]].decode())
    return out


def test_units_are_cut_in_one_walk_but_for_late_pieces(spark):
    model = pieces.load(tokenizer_path())
    scores = {p: (i, s) for p, i, s in model.pieces}
    # runs of spaces are joined out of the order of their scores: "▁▁" scores below "▁▁▁▁"
    assert {"▁▁▁", "▁▁▁▁"} <= model.late < set(scores) and all(set(p) == {"▁"} for p in model.late)
    units = {"▁", "▁▁▁▁▁▁▁the", "▁" * 22 + "word", "▁" * 32, "a" * 32, "日本語", "▁\n\n\n\t", "========", "ñé", "▁the"}
    units |= set(list(scores)[::40])
    rows = spark.createDataFrame([(u,) for u in units], "unit string")
    expected = {u: pieces.encode_long(u, scores, model) for u in units}
    assert {r.unit: list(r.ids) for r in pieces.encode_units(rows, model).collect()} == expected
    assert {r.unit: r.cuts for r in pieces.cut_units(rows, model).collect()} == {
        u: starts_of(u, ids, model) for u, ids in expected.items()
    }


def test_units_and_their_answers_take_few_bytes(spark, workdir):
    import random

    import pyarrow as pa

    dealt = random.Random(5)
    units = ["▁" + "".join(dealt.choices(["th", "er", "on", "an", "re", "ed"], k=dealt.randint(2, 5))) for _ in range(40000)]
    docs = documents(spark, [(0, " ".join(u[1:] for u in units), "a")]).coalesce(1)
    with common.recorded() as made:
        pieces.encode(docs, pieces.load(tokenizer_path()))
    size = sum(f.stat().st_size for path in made for f in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet"))
    # Arrow lists of them took 4.9 bytes each
    assert size < 3.5 * len(set(units))
    order, own = pieces._shares(pa.array(sorted(set(units))), 4)
    found = pa.table({"block": [0] * 4, "share": list(own), "units": [pieces._squeezed(t) for *_, t in own.values()]})
    known = pa.table({"unit": sorted(set(units)), "cuts": [0b100101] * len(set(units))})
    answers = pieces._answered(found, known)
    assert sorted(order) == list(range(len(set(units)))) and answers.num_rows == 4
    assert sum(len(a.as_py()) for a in answers.column("cuts")) < len(set(units))


def best_cost(unit, scores, unknown):
    """The largest sum of scores over all ways to cut the unit."""
    costs = [scores[unit][1]] if unit in scores else [unknown] if len(unit) == 1 else []
    for at in range(1, len(unit)):
        head = unit[:at]
        first = scores[head][1] if head in scores else unknown if at == 1 else None
        if first is not None:
            costs.append(first + best_cost(unit[at:], scores, unknown))
    return max(costs)


def test_viterbi_equals_exhaustive_search(spark, workdir):
    model = pieces.load(as_unigram(tokenizer_path(), f"{workdir}/unigram.model"))
    assert model.kind == pieces.UNIGRAM
    scores = {p: (i, s) for p, i, s in model.pieces}
    score = {i: s for _, i, s in model.pieces}
    units = ["▁hello", "▁the", "abcabc", "▁thonerer", "▁ing", "x"]
    rows = spark.createDataFrame([(u,) for u in units], "unit string")
    got = {r.unit: list(r.ids) for r in pieces.encode_units(rows, model).collect()}
    for u in units:
        assert sum(score[i] for i in got[u]) == best_cost(u, scores, model.unknown_score)
        assert b"".join(model.spelled[i] for i in got[u]).decode() == u.replace("▁", " ")
        assert sum(score[i] for i in pieces.encode_long(u, scores, model)) == sum(score[i] for i in got[u])


# --- 3 -------------------------------------------------------------------------------


def sets_of(rows, n):
    out = []
    for i, t, _ in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n
                    else frozenset([tuple(w)] if w else [])))
    return out


def expected_components(rows, n, percent):
    sets = sets_of(rows, n)
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _) in enumerate(sets):
        t = top(k)
        least[t] = min((v for v in (least.get(t), i) if v is not None), default=None)
    return Counter((i, len(s), least[top(k)], i == least[top(k)]) for k, (i, s) in enumerate(sets))


def near_copies(n):
    """A chain of texts, each a few words from the one before, and unrelated ones."""
    words = [f"t{i}" for i in range(90)]
    out = []
    for k in range(n):
        words = words[:]
        words[(k * 11) % 90] = f"n{k}"
        out.append((100 + k, " ".join(words), "a"))
    return out + [(500 + k, " ".join(f"u{k}x{i}" for i in range(40)), "b") for k in range(5)]


@pytest.mark.parametrize("cfg", [near_dup.NearDup(), near_dup.NearDup(leaf=4, deepest=6)])
def test_near_duplicates_equal_brute_force(spark, cfg):
    rows = ODD + near_copies(24)
    got = near_dup.near_duplicates(documents(spark, rows), cfg).collect()
    assert Counter(tuple(r) for r in got) == expected_components(rows, 3, 85)


def test_near_duplicates_empty_and_distinct(spark):
    docs = documents(spark, ODD)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
    kept = near_dup.distinct_documents(docs, near_dup.NearDup(shingle=5, percent=80))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 3, 4, 5, 6, 8, 9, 10, 11]


def test_one_document_of_each_component(spark):
    """Also where near copies have no id, or several texts have the smallest."""
    def copies(name, ids):
        words = [f"{name}{i}" for i in range(120)]
        return [(i, " ".join([*words[:k], f"new{k}", *words[k + 1 :]]), "a") for k, i in enumerate(ids)]

    groups = [copies("a", [None] * 4), copies("b", [5, 5, 5, 6]), copies("c", [None, 8, 8]), copies("d", [9])]
    blank = [(20, None, "a"), (20, " ", "a"), (None, "", "a")]
    docs = documents(spark, [r for g in groups for r in [*g, g[0]]] + blank)
    kept = near_dup.distinct_documents(docs, near_dup.NearDup(shingle=5, percent=80)).collect()
    names = Counter((r.text.split()[-1][0], r.doc_id) for r in kept if r.text and r.text.strip())
    assert names == {("a", None): 1, ("b", 5): 1, ("c", 8): 1, ("d", 9): 1}
    assert len(kept) == 4 + len(blank)


def word_shingles(text, n):
    w = [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("slice_bits", [6, 18])
def test_shingle_hashes_tell_shingles_apart(slice_bits):
    tables = near_dup.hash_tables(slice_bits)
    texts = [t for _, t, _ in ODD] + ["x" * 300 + " y z" * 50, "a b", "A B c\x0bD", "b a", "é\u00a0x É x"]
    for n in (1, 3, 5):
        sets = [(word_shingles(t, n), set(near_dup.shingle_set((t or "").encode(), n, tables).tolist())) for t in texts]
        assert all(len(a) == len(b) for a, b in sets)
        assert all(len(a & c) == len(b & d) for a, b in sets for c, d in sets)


def test_exact_links_equal_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 9000)
    sets = [np.unique(np.r_[base[k * 40 :], rng.integers(0, 1 << 62, 9)]) for k in range(12)]
    labels = np.array([bytes([k]) for k in range(12)], object)
    linked = near_dup.exact_links(labels, sets, 99)
    for a, b in linked:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 99 * (len(sets[a]) + len(sets[b]) - both)
    assert len(linked) == 11


@pytest.mark.parametrize("name", ["query", "pipeline"])
def test_trees_share_no_slot(name):
    import corpus_pipeline
    import numpy as np
    import pyarrow as pa

    cfg = near_dup.NearDup() if name == "query" else corpus_pipeline.NEAR
    plain = np.random.default_rng(5).integers(0, 1 << 16, cfg.slots, dtype=np.uint16)
    tokens = np.tile(plain, (cfg.slots + 1, 1))
    tokens[np.arange(cfg.slots), np.arange(cfg.slots)] ^= 1
    batch = pa.RecordBatch.from_arrays(
        [pa.array([x.tobytes() for x in tokens], pa.binary()), pa.array([b"%d" % i for i in range(len(tokens))], pa.binary())],
        names=["tokens", "key"],
    )
    rows = [r for b in near_dup._descend(cfg, cfg.depth, True)([batch]) for r in b.to_pylist()]
    own = {r["node"] for r in rows if r["key"] == b"%d" % cfg.slots}
    left = Counter(r["key"] for r in rows if r["node"] not in own)
    assert len(own) == cfg.trees and len(rows) == cfg.trees * len(tokens)
    # a changed token leaves all trees but one as they are, and depth of them reach each tree
    assert set(left.values()) == {1} and len(left) == cfg.trees * cfg.depth


# --- 4 -------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_rules(spark):
    junk = [(50 + k, " | ".join(f"j{k}x{i}" for i in range(80)), "a") for k in range(6)]
    good = [(80 + k, " ".join(f"g{(i + k) % 70}" for i in range(70)), "a") for k in range(20)]
    docs = documents(spark, ODD + junk + good)
    trusted = spark.createDataFrame([(80 + k,) for k in range(14)], "doc_id long")
    got = quality_rules.judge(docs, trusted).collect()
    assert len(got) == docs.count()
    want = Counter((i, *base_counts(t)) for i, t, _ in ODD + junk + good)
    assert Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    ) == want
    assert all(r.kept == (not r.base_failed and r.llr >= quality_rules.QualityRules().threshold) for r in got)
    kept = {r.doc_id for r in got if r.kept}
    assert {80 + k for k in range(20)} <= kept and not kept & {50 + k for k in range(6)}
    passed = quality_rules.keep_good(docs, trusted)
    assert passed.columns == docs.columns and {r.doc_id for r in passed.collect()} == kept
    assert all(r.llr == 0 for r in quality_rules.judge(docs, trusted.limit(0)).collect())
    assert quality_rules.judge(docs.limit(0), trusted).count() == 0


# --- 5 -------------------------------------------------------------------------------


def test_classifier_learns_and_defines_odd_cases(spark):
    rows = [(i, " ".join(f"{'good' if i % 2 else 'bad'}word{j % 9}" for j in range(30)), "a") for i in range(200)]
    docs = documents(spark, rows + [(900, None, "a"), (901, "", "a"), (None, "good", "a")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)] + [(3, 0), (5, None)], "doc_id long, label int")
    held = quality_classifier.held_out(docs.doc_id)
    cfg = quality_classifier.Trainer(epochs=8, bits=12, dim=4)
    learn = labels.filter(~quality_classifier.held_out(labels.doc_id))
    model = quality_classifier.fit(docs, learn, cfg)
    got = quality_classifier.score(docs, model).collect()
    assert len(got) == docs.count()
    flags = {r.doc_id: r.h for r in docs.select("doc_id", held.alias("h")).collect()}
    scored = [r for r in got if r.doc_id is not None and r.doc_id < 200 and r.held_out]
    assert all(r.held_out == flags[r.doc_id] and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == r.doc_id % 2 for r in scored) >= 0.95 * len(scored)
    again = quality_classifier.fit(docs, learn, cfg)
    assert (again.vectors == model.vectors).all()
    none = quality_classifier.fit(docs, learn.limit(0), cfg)
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), model).count() == 0


def test_classifier_learns_from_one_text_an_id(spark, monkeypatch):
    trained = quality_classifier._train

    def counted(cfg):
        import pyarrow as pa

        def run(batches):
            batches = list(batches)
            if sum(b.num_rows for b in batches) > cfg.sample:
                raise ValueError("more rows than the sample")
            ids = [d for b in batches for d in b.column("doc_id").to_pylist()]
            assert len(ids) == len(set(ids)) == 20 and isinstance(batches[0], pa.RecordBatch)
            yield from trained(cfg)(iter(batches))

        return run

    monkeypatch.setattr(quality_classifier, "_train", counted)
    rows = [(i, f"{'good' if i % 2 else 'bad'} word{i}", "a") for i in range(20)]
    rows += [(3, f"good again {k % 4}", "a") for k in range(40)] + [(4, " ", "a"), (4, None, "a")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    cfg = quality_classifier.Trainer(sample=20, epochs=2, bits=10, dim=4)
    first = quality_classifier.fit(documents(spark, rows).repartition(5), labels, cfg)
    again = quality_classifier.fit(documents(spark, rows[::-1]).repartition(2), labels, cfg)
    assert (first.vectors == again.vectors).all()


# --- 6 -------------------------------------------------------------------------------


def test_warc_round_trip(spark, workdir):
    rows = [(1, "http://a/\n", "same"), (2, None, "same"), (9, "u", "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 70_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha string")
    made = warc_zip.write_packages(pages, scratch_path(spark, "t-warc"))
    got = {r.page_id: r for r in warc_zip.read_packages(made).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 9}
    for i, _, html in rows:
        body = (html or "").encode()
        assert got[i].payload_bytes == len(body)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if got[i].record_type == "response":
            assert bytes(got[i].payload) == body
    assert {i: got[i].refers_to for i in got} == {1: 9, 2: 9, 9: None, 3: 4, 4: None, 5: None}
    assert got[1].url == "http://a/%0A" and got[2].url is None
    few = warc_zip.write_packages(pages, scratch_path(spark, "t-warc"), min_bytes=5)
    assert {r.record_type for r in warc_zip.read_packages(few, ["record_type"]).collect()} == {"response"}
    none = warc_zip.write_packages(pages.limit(0), scratch_path(spark, "t-warc"))
    assert warc_zip.read_packages(none).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_zip_directory(wide):
    body = warc_zip.package([warc_zip.gzip_member(b"one"), warc_zip.gzip_member(b"two")], force_zip64=wide)
    f = io.BytesIO(body)
    members = warc_zip.central_directory(f, len(body))
    with zipfile.ZipFile(f) as z:
        assert set(members) == set(z.namelist())
        for name, entry in members.items():
            at, n = warc_zip.member_range(f, entry)
            assert body[at : at + n] == z.read(name)


def test_zip64_end_record(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    body = warc_zip.package([warc_zip.gzip_member(b"x" * 99)], force_zip64=True)
    assert b"PK\x06\x06" in body
    members = warc_zip.central_directory(io.BytesIO(body), len(body))
    at, n = warc_zip.member_range(io.BytesIO(body), members[warc_zip.DATA])
    assert warc_zip.zlib.decompress(body[at : at + n], 31) == b"x" * 99


# --- 7 -------------------------------------------------------------------------------


def test_line_chunks(spark):
    passage = "\n".join(f"shared line {i} of a long passage that many hold" for i in range(30))
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(12)] + [passage] + [f"end {i} {j}" for j in range(9)]), "a") for i in range(6)]
    docs = documents(spark, [*rows, (10, rows[0][1], "a"), (11, None, "a"), (12, "", "b"), (13, "single", "b"), (13, "single", "b")])
    cut = docs.select("doc_id", "text", line_dedup.chunks(docs.text).alias("c")).collect()
    for r in cut:
        if r.text:
            assert "\n".join(x.text for x in r.c) == r.text
            assert all(x.text.count("\n") + 1 == x.lines for x in r.c)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[0] == [rows[0][1]] and got[13] == ["single"] * 2 and got[11] == [None] and got[12] == [""]
    for i in range(1, 6):
        left = got[i][0].count("shared line")
        assert left < 8 and got[i][0].count("own") == 12 and got[i][0].count("end") == 9
    want = without_repeated_units({(r.doc_id, r.text): [(x.text, x.lines) for x in r.c] for r in cut if r.c})
    for (i, _), t in want.items():
        assert got.get(i, [None])[0] == t
    report = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert report[3].kept_chars == len(got[3][0]) and report[11].n_chunks == 0
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def without_repeated_units(chunks):
    """Brute force on {(id, text): [(chunk, lines)]}: the text left, None where the document is dropped."""
    order = sorted(chunks, key=lambda k: (k[0] is not None, k[0]))
    places = {}  # unit -> its places (document, first chunk, last chunk) in order
    for n, key in enumerate(order):
        c = chunks[key]
        for k, (text, lines) in enumerate(c):
            if lines >= 2 and WORD.search(text):
                places.setdefault((text,), []).append((n, k, k))
            if k + 1 < len(c) and WORD.search(text + c[k + 1][0]):
                places.setdefault((text, c[k + 1][0]), []).append((n, k, k + 1))
    later = {p for found in places.values() for p in found[1:]}
    gone = {}
    for found in places.values():
        kept = [
            p for p in found
            if not any(q != p and q[0] == p[0] and q[1] <= p[2] and p[1] <= q[2] for q in later)
        ]
        for n, a, b in found[1:] if kept else []:
            if (n, a, b) != kept[0]:
                gone.setdefault(n, set()).update(range(a, b + 1))
    out = {}
    for n, key in enumerate(order):
        left = [t for k, (t, _) in enumerate(chunks[key]) if k not in gone.get(n, ())]
        out[key] = key[1] if n not in gone else "\n".join(left) if any(map(WORD.search, left)) else None
    return out


def chunks_of(docs):
    rows = docs.select("doc_id", "text", line_dedup.chunks(docs.text).alias("c")).collect()
    return {(r.doc_id, r.text): [(x.text, x.lines) for x in r.c] for r in rows if r.c}


def test_repeated_passages_go(spark):
    """Passages of 3 to 8 lines and over 50 words: all that whole units cover, and every
    removed passage is still found in one piece somewhere."""
    from corpus_pipeline import STAGES

    passages = {
        (n, v): "\n".join(f"p{n}v{v} line {j} " + " ".join(f"w{n}{v}{j}{x}" for x in range(17)) for j in range(n))
        for n in range(3, 9) for v in range(5)
    }
    rows, i = [], 0
    for p in passages.values():
        for k in range(3):
            own = [f"own {i} {j}" for j in range(4 + k)]
            rows.append((i, "\n".join([*own[: 2 + k], p, *own[2 + k :]])))
            i += 1
    rows += [(900, rows[4][1]), (901, "one\n\n\n\ntwo\nthree\n\n"), (902, "one\n\n\n\ntwo\nthree\n\n"), (903, None),
             (904, ""), (905, "x\nx\nx\ny"), (None, "y\none\nend"), (906, "\n\n"), (907, "\n\n"), (908, "own 3 0\nown 3 1"),
             (908, "own 3 0\nown 3 1"), (909, rows[0][1] + "\n" + rows[1][1])]
    docs = documents(spark, [(i, t, "a") for i, t in rows])
    docs = docs.withColumn("n_chars", F.length("text"))
    want = without_repeated_units(chunks_of(docs))
    got = dict(STAGES)["line dedup"](spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        (i, want[i, t] if t else t) for i, t in rows if not t or want[i, t] is not None
    )
    texts = [r.text or "" for r in got]
    whole = sum(sum(p in t for t in texts) == 1 for p in passages.values())
    copies = sum(t.count(line) for t in texts for p in passages.values() for line in p.split("\n"))
    lines = sum(p.count("\n") + 1 for p in passages.values())
    assert whole > len(passages) / 2 and copies < 2 * lines, (whole, copies, lines)
    assert all(any(p in t for t in texts) for p in passages.values())
    assert not {900, 902} & {r.doc_id for r in got}
    report = {(r.doc_id, r.n_chars): r for r in line_dedup.line_report(docs).collect()}
    assert all(report[i, len(t)].kept_chars == len(want[i, t] or "") for i, t in rows if t)
    assert all(report[i, len(t)].n_chunks == len(c) for (i, t), c in chunks_of(docs).items())


def test_units_that_overlap_leave_one_whole(spark):
    """With a boundary after every line: b-c is first found where a-b takes its b away."""
    every = line_dedup.Chunking(divisor=1 << 50)
    rows = [(1, "a\nb"), (2, "a\nb\nc"), (3, "b\nc"), (4, "head\nb\nc\ntail")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, [(*r, "s") for r in rows]), every).collect()}
    assert got == {1: "a\nb", 2: "c", 3: "b\nc", 4: "head\ntail"}


# --- 8 -------------------------------------------------------------------------------


def test_nearest_equals_brute_force(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(160, 24)).astype(np.float32)
    x[50:60] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(200, None), (201, [0.0] * 24), (202, [None] + [1.0] * 23), (203, [float("inf")] + [1.0] * 23),
           (204, [float("nan")] * 24), (205, [1.0, 2.0]), (None, [1.0] * 24), (7, x[7].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(nearest, "CANDIDATE_BLOCK", 40)
    got = {}
    for r in nearest.nearest(df, df.vec_id % 20 == 0, 20).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    exact = x.astype(np.float64)
    for q in range(0, 160, 20):
        s = np.einsum("ij,j->i", exact, exact[q])
        order = [i for i in sorted(range(160), key=lambda i: (-s[i], i)) if i != q][:20]
        assert [got[q][k][0] for k in range(1, 21)] == order
        assert np.allclose([got[q][k][1] for k in range(1, 21)], s[order], rtol=1e-12)
    assert set(got) == set(range(0, 160, 20))
    few = nearest.nearest(df.filter("vec_id < 5"), df.vec_id == 0, 20)
    assert few.count() == 4
    assert nearest.nearest(df.limit(0), df.vec_id % 20 == 0).count() == 0


# --- 9 -------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_cache(spark, name, monkeypatch):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        encode = lambda x: t.encode(x, add_special_tokens=False).ids
    cache = scratch_path(spark, "t-cache")
    docs = documents(spark, ODD)
    first = token_counts.token_counts(docs.filter("doc_id < 5"), path, cache, limit=100)
    assert first.count() == 5
    got = token_counts.token_counts(docs, path, cache, limit=100).collect()
    want = Counter((i, len((t or "").encode()), n := len(encode(t or "")), n > 100) for i, t, _ in ODD)
    assert Counter(tuple(r) for r in got) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t, _ in ODD})
    token_counts.token_counts(docs, path, cache).count()
    assert spark.read.parquet(cache).count() == stored.count()
    assert token_counts.token_counts(docs.limit(0), path, cache).count() == 0


# --- 10 ------------------------------------------------------------------------------


def expected_targets(sizes, percent=150, epochs=2, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = {}, sum(sizes.values()) * percent / 100
    while True:
        left = [s for s in names if s not in capped]
        share = (total - sum(capped.values())) / max(1, sum(w[s] for s in left))
        over = [s for s in left if share * w[s] > epochs * sizes[s]]
        if not over:
            return {s: capped.get(s, share * w[s]) for s in names}
        capped |= {s: float(epochs * sizes[s]) for s in over}


def test_mixing(spark):
    rows = ODD + [(1000 + i, "w " * (i % 17), f"s{i % 5}") for i in range(400)] + [(2000 + i, "v " * 30, "s1") for i in range(300)]
    docs = documents(spark, rows)
    base = mixing.sized(docs)
    got = mixing.queue(base).collect()
    assert len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    targets = expected_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    assert sum(taken.values()) * 100 <= 150 * sum(sizes.values())
    longest = {s: max(size(t) for _, t, x in rows if x == s) for s in sizes}
    for s in sizes:
        if longest[s] < targets[s] / 10:
            assert abs(taken[s] - targets[s]) <= 2 * longest[s], s
    assert sorted(map(str, got)) == sorted(map(str, mixing.queue(mixing.sized(docs)).collect()))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(size(r.text) for r in mixed.collect()) == sum(taken.values())
    assert mixing.queue(mixing.sized(docs.limit(0))).count() == 0
    assert mixing.mixed(docs.filter("doc_id in (3, 4)")).count() == 0


def test_mixing_does_not_depend_on_the_layout(spark, monkeypatch):
    """Rows that share ids but not texts, in two layouts and in ranges of any size."""
    rows = [(i % 3 if i % 4 else None, "w " * (i % 11) + f"t{i}", f"s{i % 2}") for i in range(99)]
    rows += [(5, "the same", "s0")] * 7
    docs = documents(spark, rows)
    report = lambda d: Counter(
        tuple(r) for r in mixing.queue(mixing.sized(d)).drop("uid").collect()
    )
    whole = report(docs.coalesce(1))
    assert report(docs.repartition(7, "text")) == whole
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    ordered = docs.repartition(5, "source", "text")
    assert report(ordered) == whole
    base = mixing.sized(ordered)
    ranged = mixing._running(base, ["doc_id", "size", "text_hash", "uid"], "_cum", 11)
    assert ranged.agg(F.max("_cum")).first()[0] == base.agg(F.sum("size")).first()[0]
    counts = base.repartitionByRange(11, "doc_id", "size", "text_hash", "uid").groupBy(F.spark_partition_id()).count()
    assert counts.agg(F.max("count")).first()[0] < 25  # rows without an id alone are 25
