"""The pipeline's stages in turn, each judged on its own input."""

from __future__ import annotations

import corpus_pipeline
from textlab.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import sentencepiece

    from textlab.llm.queries import tokenizer_path

    docs = read(spark, SF, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near dedup", "mixing", "sentencepiece"]
    good = stages["quality rules"](spark, docs, SF).cache()
    assert good.columns == columns and 0 < good.count() < docs.count()
    lines = stages["line dedup"](spark, good, SF).cache()
    assert lines.columns == columns and lines.dtypes == good.dtypes
    ids = {r.doc_id for r in good.collect()}
    assert all(r.doc_id in ids and r.n_chars == len(r.text) for r in lines.collect())
    near = stages["near dedup"](spark, lines, SF).cache()
    assert near.columns == columns
    assert near.count() == near.select("doc_id").distinct().count() <= lines.count()
    mixed = stages["mixing"](spark, near, SF).cache()
    assert mixed.columns == columns and mixed.count() > 0
    encoded = stages["sentencepiece"](spark, mixed, SF).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(encoded) == mixed.count()
    assert all(list(r.ids) == lib.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in encoded)


def test_stages_take_an_empty_table(spark):
    docs = read(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_broadcast_hints_are_bounded():
    """Of this package's hinted tables one has a row a piece of the model, the others a row
    a sampled id; nothing else carries a hint."""
    import pathlib

    from textlab.llm import pieces, quality_classifier

    root = pathlib.Path(pieces.__file__).parent
    hits = {
        (py.name, line.strip())
        for py in root.glob("*.py") for line in py.read_text().splitlines() if "F.broadcast(" in line
    }
    assert {name for name, _ in hits} == {"pieces.py", "quality_classifier.py"}
    assert len(hits) == 3
    from textlab.llm.queries import tokenizer_path

    assert len(pieces.load(tokenizer_path()).pieces) <= 1 << 16
    assert quality_classifier.Trainer().sample <= 6144
