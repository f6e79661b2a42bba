import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from truant.llm import packing

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATHS[0])


@pytest.mark.parametrize("text", [
    "", " ", "   ", "a", "a b", "a  b", "a   b", " a", "a ", "a  ", "a\n b", "a \nb", "a\n \nb", "a\n ", "a \n", "\n\n a\t b \t c", "it's  we'll", "é ñ 漢字 😀 x",
    "end<|endoftext|> of text", "a\u00a0 b", "a \u3000b", "a\x1f b \x1f c", "x" * 3000, "word " * 3000, "1 22 333 4444  5", "a\r\n b\r\n",
])
def test_ids_are_the_tokenizers(tokenizer, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    for encode in (packing.encoder(*PATHS), packing.encoder(PATHS[0])):
        assert np.frombuffer(encode(text), "<u4").tolist() == want


def check(rows, pieces, tokenizer, length):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
        assert p.length > 0 and p.ids_crc32 == zlib.crc32(part)
        by_doc[p.doc_id].append((p.start, p.length))
        by_seq[p.sequence_id].append((p.offset, p.length))
    for i, all_ids in ids.items():
        assert [s for s, _ in sorted(by_doc[i])] == list(np.cumsum([0] + [n for _, n in sorted(by_doc[i])])[:-1])
        assert sum(n for _, n in by_doc[i]) == len(all_ids)
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= length
    return sum(n for parts in by_seq.values() for _, n in parts) / (length * len(by_seq))


def test_pieces_cover_all_ids_once(docs_of, tokenizer):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "delta\n"], n))) for i, n in enumerate(rng.integers(0, 400, 400))]
    rows += [(1000, None), (1001, ""), (1002, "word " * 50_000), (1003, "x")]
    df = docs_of(rows).repartition(24)
    pieces = packing.pack(df, *PATHS, length=256, windows=4, fan_in=3)
    assert check(rows, pieces.collect(), tokenizer, 256) > 0.95
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_empty_and_repeated(docs_of):
    assert packing.pack(docs_of([]), *PATHS).count() == 0
    rows = packing.pack(docs_of([(1, "a b"), (1, "a b"), (None, None)]), *PATHS).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 1), (1, 3), (1, 3)]


def test_windows_are_bounded():
    rng = np.random.default_rng(1)
    p, used = packing.Packer(100, 5, 0), defaultdict(int)
    for n in rng.integers(1, 100, 3000).tolist():
        for size, seq, offset in p.place(n):
            assert used[seq] == offset
            used[seq] += size
        assert len(p.free) <= 5
    assert max(used.values()) <= 100 and sum(used.values()) / (100 * len(used)) > 0.95
