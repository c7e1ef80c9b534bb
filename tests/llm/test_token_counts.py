import random
from array import array

from tokenizers import Tokenizer

from voxloom.llm import token_counts as op
from voxloom.llm import wordbpe


def expected(rows):
    t = Tokenizer.from_file(wordbpe.default_path())
    t.encode_special_tokens = True
    return sorted((str(r.doc_id), len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in rows)


def test_counts_equal_the_tokenizer_with_blocks_of_any_size(docs, clash):
    want = expected(docs.collect())
    for df, block in ((docs, op.BLOCK_TOKENS), (docs, 7), (clash, 64)):
        assert sorted((str(r.doc_id), r.n_tokens) for r in op.token_counts(df, block_tokens=block).collect()) == want


def test_ids_of_chunks_are_those_of_the_text():
    bpe, rng = wordbpe.WordBpe(wordbpe.default_path()), random.Random(5)
    parts = [*"abcXYZ'’“”é ÀŸÿ İıſß \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2009\u3000\u200b\u0301\u0308각한日本Жд٣½²😀<|>09.-_\0\x7fǅΣς\ufeff", "'s", "'RE", "<|endoftext|>", "e\u0301", "hello", "World"]
    texts = ["", " ", *("".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000))]
    want = [array("H", bpe.whole.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert [bpe.ids(t) for t in texts] == want
    bpe.clear()
    bpe.room = 0  # nothing is kept
    assert [bpe.ids(t) for t in texts[:500]] == want[:500] and not bpe


def test_empty_table(no_docs):
    assert op.token_counts(no_docs).collect() == []


def test_flat_files_with_an_open_end(spark, tmp_path):
    import numpy as np

    np.array([5, 6, 9, 9, 7, 9, 8], "<u2").tofile(tmp_path / "a.bin")
    for block in (1, 2, 3, 100):
        blocks = op.read_flat_files(spark, f"file://{tmp_path}", 2 * block).drop("path")
        found = op.separator_scan(blocks, 9, block).orderBy("ordinal").collect()
        assert [(r.ordinal, r.start, r.n_tokens, r.closed) for r in found] == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, True), (3, 6, 1, False)]
