"""Packing and mixing: exact round trips, bounds and plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import documents, token_pieces, words
from jobsignals.llm import mixing, pattern_packing, token_output, tokens
from jobsignals.llm.tokens import WordTokens, default_tokenizer, token_batches, word_tokens

R = random.Random(3)
TEXTS = ["", None, " ", "one", "a b c " * 900, "Don't STOP 's x'll Ünï", "É́ é K İ ǅ 12.5 a1b2 x\x1cy ﬁ",
         "日本語 ---", "a<|endoftext|>b", "word!! (and) %%% more###", "one", "x" * 3000]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one"), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def extra(df):
    names = ("length", "rank", "bucket", "piece", "base", "row", "block", "weight", "times", "id")
    return df.select("*", *(F.lit("x").alias(n) for n in names))


def check_sequences(rows, most):
    """Segments of a sequence lie side by side from 0 and fit."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_ids_equal_the_tokenizer(spark, sf_dir, encode):
    import pyarrow as pa

    texts = [t or "" for t in TEXTS] + [
        r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    for most in (300_000, 3):
        coder = WordTokens(default_tokenizer(), most)
        for part in (texts, texts[:5]):
            for row, ids in token_batches(pa.array(part), coder):
                assert ids.tolist() == encode(part[row]) + [1]


def test_a_full_cache_keeps_the_words_seen_again(encode):
    import pyarrow as pa

    coder = WordTokens(default_tokenizer(), 40)
    often = "alpha beta gamma"
    for i in range(30):
        text = often + " " + " ".join(f"once{chr(97 + i)}{chr(97 + j)}" for j in range(25))
        (_, ids), = token_batches(pa.array([text]), coder)
        assert ids.tolist() == encode(text) + [1]
        assert set(often.split()) <= set(coder.places) and coder.n_words <= 100
    assert not any(w.startswith("oncea") for w in coder.places)


class Counting:
    """A tokenizer that counts the texts and characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts, self.chars = tokenizer, 0, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **more)


def test_plain_words_are_encoded_together_and_once(encode):
    import pyarrow as pa

    r = random.Random(5)
    new = sorted({"".join(r.choices("abcdefgéàöÿßthe", k=r.randrange(1, 40))) for _ in range(1500)})
    texts = [" ".join(new), " ".join(reversed(new)), "The END, the end."]
    coder = WordTokens(default_tokenizer())
    coder.light = counting = Counting(coder.light)
    for _ in range(2):
        for row, ids in token_batches(pa.array(texts), coder):
            assert ids.tolist() == encode(texts[row]) + [1]
    # Far fewer texts than words, and no word twice.
    assert 0 < counting.texts <= len(new) / 50 and counting.chars <= len(" ".join(new)) + 10


def test_words_without_marked_ends_are_encoded_apart(encode):
    import pyarrow as pa

    coder = WordTokens(default_tokenizer())
    coder.last[:] = False
    for row, ids in token_batches(pa.array([t or "" for t in TEXTS]), coder):
        assert ids.tolist() == encode(TEXTS[row] or "") + [1]


def test_kept_words_are_bounded_in_bytes(encode, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "MOST_BYTES", 20_000)
    coder = WordTokens(default_tokenizer())
    for i in range(12):
        text = f"alpha beta {chr(97 + i) * 3000} {i}{'é' * 500}."
        (_, ids), = token_batches(pa.array([text]), coder)
        assert ids.tolist() == encode(text) + [1]
        assert {"alpha", "beta"} <= set(coder.places) and coder.n_bytes <= 40_000


def test_a_worker_keeps_its_words():
    assert word_tokens(default_tokenizer()) is word_tokens(default_tokenizer())


@pytest.mark.parametrize("most", [64, 4096])
def test_every_piece_is_packed_once(spark, encode, most):
    rows = ROWS + [(100 + i, " ".join(R.choices("abcdefgh", k=R.randrange(most)))) for i in range(80)]
    got = pattern_packing.pack(extra(documents(spark, rows)), most).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got
                   ) == token_pieces(rows, most, encode)
    plain = token_output.best_fit_decreasing([r.length for r in got], most)
    assert check_sequences(got, most) <= len(plain) + 1


def test_packing_of_the_table_is_tight(spark, sf_dir, encode):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = pattern_packing.pack(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got
                   ) == token_pieces(rows, 4096, encode)
    lengths = [r.length for r in got]
    assert check_sequences(got, 4096) <= len(token_output.best_fit_decreasing(lengths, 4096)) + 1


def test_packing_of_nothing(spark):
    none = documents(spark, ROWS).where("false")
    assert pattern_packing.pack(none).isEmpty()
    assert token_output.packed_report(none).isEmpty()
    assert mixing.mix_report(none).isEmpty() and mixing.mixed(none).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 128), min_size=1, max_size=300))
def test_plan_has_a_place_for_every_length(lengths):
    counts = Counter(lengths)
    plan = pattern_packing.plan_patterns(counts, 128, 16)
    placed = Counter()
    for content, n in plan.kinds:
        assert sum(content) <= 128 and n > 0
        for x in content:
            placed[x] += n
    assert placed == counts
    assert plan.sequences <= len(token_output.best_fit_decreasing(lengths, 128)) + 2


def test_nnls_solves_what_it_can():
    rng = np.random.default_rng(1)
    a = rng.random((20, 60))
    x = np.maximum(rng.normal(size=60), 0)
    got = pattern_packing.nnls(a, a @ x)
    assert (got >= 0).all() and np.allclose(a @ got, a @ x, atol=1e-6)
    assert np.allclose(pattern_packing.nnls(np.eye(3), np.array([1.0, -2.0, 3.0])), [1, 0, 3])


def test_patterns_fill_a_sequence():
    got = pattern_packing.full_patterns(12, 3)
    assert len(got) == len(set(got)) == 1 + 6 + 12
    assert all(sum(p) == 12 and list(p) == sorted(p, reverse=True) for p in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_segment_tree_is_best_fit(lengths):
    rooms, want = [], 0
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            want += 1
            rooms.append(50 - x)
    plan = token_output.best_fit_decreasing(lengths, 50)
    assert len(plan) == want and sorted(i for p in plan for i in p) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in p) <= 50 for p in plan)


def test_written_matrices_read_back(spark, tmp_path, encode, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 2000)
    path = str(tmp_path / "packed")
    token_output.write_packed(extra(documents(spark, ROWS)), path, 256)
    rows = token_output.read_packed(spark, path)
    got = token_output.segments(rows).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got
                   ) == token_pieces(ROWS, 256, encode)
    assert all(r.resets for r in got)
    check_sequences(got, 256)
    whole = rows.collect()
    ids = token_output.matrix(whole, 256)
    assert ids.shape == (len(whole), 256)
    for row, r in zip(ids, whole):
        cu = np.frombuffer(r.cu_seqlens, "<i4")
        assert cu[0] == 0 and cu[-1] == r.n_tokens and len(cu) == len(r.doc_id) + 1
        assert (row[r.n_tokens:] == 0).all()
        for doc, piece, a, b in zip(r.doc_id, r.piece, cu[:-1], cu[1:]):
            if doc is not None and doc < len(TEXTS):
                start = 256 * piece
                assert row[a:b].tolist() == (encode(TEXTS[doc] or "") + [1])[start:start + 256]


def test_packed_output_encodes_a_word_once_a_worker(encode, monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace

    class Rows:
        """A frame that hands over the function given to it."""

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(token_output, "doc_rows", lambda docs: Rows())
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    word_tokens.cache_clear()
    coder = word_tokens(default_tokenizer())
    coder.light = counting = Counting(coder.light)
    texts = ["Alpha beta, gamma", "", "beta gamma delta!", "ünï 12"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(4)), "text": texts})
    for _ in range(3):  # tasks of one worker
        for out in token_output.packed(None, 256)(iter([batch])):
            for r in out.to_pylist():
                cu = np.frombuffer(r["cu_seqlens"], "<i4")
                for doc, a, b in zip(r["doc_id"], cu[:-1], cu[1:]):
                    assert np.frombuffer(r["ids"], "<u2")[a:b].tolist() == encode(texts[doc]) + [1]
    assert (counting.texts, counting.chars) == (1, len("alpha beta gamma delta ünï"))
    word_tokens.cache_clear()


SOURCES = ([(i, "w " * (1 + i % 7), "large") for i in range(700)]
           + [(1000 + i, "w " * 5, "small") for i in range(60)]
           + [(2000 + i, "w " * 9, None) for i in range(20)]
           + [(3000, "", "none"), (3001, None, "none"), (None, "w w", "small"), (5, "w " * 6, "large"),
              (5, "w " * 6, "large")])


def shares(rows):
    tokens = Counter()
    for _, text, source in rows:
        tokens[source or ""] += len(words(text))
    return tokens


def test_blocks_are_whole_permutations(spark):
    got = mixing.mix_report(extra(documents(spark, SOURCES)), max_repeats=3.0).collect()
    docs, tokens = defaultdict(Counter), shares(SOURCES)
    for d, text, source in SOURCES:
        docs[source or ""][d] += 1
    blocks = defaultdict(list)
    for r in got:
        blocks[r.source, r.block].append(r)
    last = {}
    for (source, block), rows in blocks.items():
        rows.sort(key=lambda r: (r.start, r.n_tokens > 0))
        at = 0
        for r in rows:
            assert r.start == at
            at += r.n_tokens
        last[source] = max(block, last.get(source, 0))
        mine = Counter(r.doc_id for r in rows)
        if at == tokens[source]:
            assert mine == docs[source]
        else:
            assert not mine - docs[source]
    used = Counter()
    for r in got:
        used[r.source] += r.n_tokens
    # The smallest share is repeated as often as the limit says, the largest once.
    assert used["large"] == tokens["large"] and last["none"] == 0
    assert abs(used[""] - 3 * tokens[""]) <= 9
    assert [r.doc_id for r in sorted(blocks["large", 0], key=lambda r: r.start)] != sorted(
        r.doc_id for r in blocks["large", 0] if r.doc_id is not None)


def test_target_entropy_is_met(spark):
    rows = mixing.save(mixing.token_rows(documents(spark, SOURCES)), "t")
    sources = mixing.source_tokens(rows)
    for target in (0.3, 0.9, 1.4):
        a = mixing.bisect_exponent(sources, target, None, None)
        weight = np.array([t for t in shares(SOURCES).values() if t], float)
        weight = (weight / weight.sum()) ** a
        weight /= weight.sum()
        entropy = -(weight * np.log2(weight)).sum()
        assert a == 1.0 or math.isclose(entropy, target, abs_tol=1e-6)


def test_a_budget_is_kept(spark):
    got = mixing.mix_report(documents(spark, SOURCES), max_repeats=2.0, budget=1000).collect()
    weight = {r.source: r.weight for r in got}
    used = Counter()
    for r in got:
        used[r.source] += r.n_tokens
    assert math.isclose(sum(weight.values()), 1, abs_tol=1e-5)
    for source, w in weight.items():
        if w:
            assert -1 <= used[source] - 1000 * w <= 10


def test_mixed_rows_are_the_reports(spark):
    docs = extra(documents(spark, SOURCES))
    got = mixing.mixed(docs, max_repeats=3.0)
    assert got.columns == docs.columns
    report = mixing.mix_report(docs, max_repeats=3.0)
    assert (Counter((r.doc_id, r.source or "") for r in got.collect())
            == Counter((r.doc_id, r.source) for r in report.collect()))


def test_mixing_stays_in_the_jvm(spark, sf_dir):
    plan = mixing.mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas"))
