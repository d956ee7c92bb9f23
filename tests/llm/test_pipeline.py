"""The pipeline, stage by stage, against plain Python."""

from collections import Counter

import pytest

import corpus_pipeline
from helpers import lower, near_components, token_pieces
from jobsignals.llm import mixing, quality_rules
from jobsignals.llm.tokens import default_tokenizer


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = corpus_pipeline.table(spark, sf_dir, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, corpus_pipeline.save(stage(spark, docs, sf_dir), "test")))
        docs = out[-1][1]
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.select("doc_id", "text", "source").exceptAll(
            before.select("doc_id", "text", "source")).select("doc_id").join(
            before, "doc_id", "left_anti").isEmpty()


def test_rejected_documents_go(stages):
    before, after = stages[0]
    kept = {r.doc_id for r in quality_rules.quality_report(before).collect() if r.kept}
    assert Counter(d for d, _ in rows(after)) == Counter(kept) and 0 < len(kept) < before.count()


def test_the_last_of_equal_texts_stays(stages):
    before, after = stages[1]
    last = {}
    for d, t in rows(before):
        last[lower(t)] = max(d, last.get(lower(t), d))
    assert Counter(d for d, _ in rows(after)) == Counter(last.values())


def test_one_of_each_component_stays(stages):
    before, after = stages[2]
    want = {c for _, _, c in near_components(rows(before))}
    assert Counter(d for d, _ in rows(after)) == Counter(want)


def test_mixing_keeps_every_document(stages):
    before, after = stages[3]
    times = Counter(d for d, _ in rows(after))
    assert set(times) == {d for d, _ in rows(before)}
    assert max(times.values()) <= mixing.MAX_REPEATS and after.count() > before.count()
    assert times == Counter(r.doc_id for r in mixing.mix_report(before).collect())


def test_all_pieces_are_packed(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after.collect())
    assert got == token_pieces(rows(before), 4096,
                               lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    used = Counter()
    for r in after.collect():
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


def test_run_is_the_stages(spark, sf_dir, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf_dir).select(*key)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[4][1].select(*key).collect()))


def test_odd_tables(spark):
    """Nulls, empties, repeats and clashing extra columns pass every stage without failing."""
    from pyspark.sql import functions as F

    from helpers import documents

    good = " ".join(f"word{i} and more plain words here." for i in range(80))
    rows = [(1, good), (2, good), (2, good), (None, good + " x"), (3, None), (4, ""),
            (5, good.upper()), (6, "a " * 30_000)]
    docs = documents(spark, rows).select(
        "*", F.lit(1).alias("th"), F.lit("x").alias("row"), F.lit(2).alias("piece"))
    empty = documents(spark, []).select("*", F.lit(1).alias("th"))
    for frame in (docs, empty):
        current = frame
        for _, stage in corpus_pipeline.STAGES:
            current = corpus_pipeline.save(stage(spark, current, ""), "odd")
        out = current.collect()
        if frame is empty:
            assert out == []
        else:
            assert {r.doc_id for r in out} <= {1, 2, None, 5, 6}
