"""Token ids, packing and token files: exact against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strideframe.llm import bitplanes, packing
from strideframe.llm.tokens import BySpace, ByWord, ChunkEncoder, load

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
RULES = [(WORD, ByWord), (BYTE, BySpace)]

HARD = [
    None,
    "",
    " ",
    "a  b",
    "a   b",
    " lead",
    "trail  ",
    "x \n y",
    "tab\t z",
    "it's we'LL 'S I'm",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>",
    "é é ́x İ Σ ΣΑΣ ǅ ß",
    "a b　 c\x1c d\x85 e",
    "\n\n\n a",
    "日本 語 テスト 🎉🎉 x",
    "12 345 6.7% a1b2",
    "\x00 a \r\n b",
]


def library_ids(path, text):
    return load(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("path", "rule"), RULES)
def test_hard_texts_alone_and_together(path, rule):
    encoder = ChunkEncoder(path, rule)
    flat, counts = encoder.encode(HARD)
    ends = np.cumsum(counts)
    for text, b, e in zip(HARD, ends - counts, ends, strict=True):
        assert flat[b:e].tolist() == library_ids(path, text), text
    assert encoder.encode([])[0].tolist() == []


@pytest.mark.parametrize(("path", "rule"), RULES)
def test_any_text(path, rule):
    encoder = ChunkEncoder(path, rule)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from("ab Zé'ts\n\t09.|日 ́<>"), max_size=30), max_size=4))
    def same(texts):
        flat, counts = encoder.encode(texts)
        assert flat.tolist() == [i for t in texts for i in library_ids(path, t)]
        assert counts.tolist() == [len(library_ids(path, t)) for t in texts]

    same()


def test_encoder_forgets_and_goes_on(monkeypatch):
    from strideframe.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 2)
    encoder = ChunkEncoder(BYTE, BySpace)
    for text in ("a b c d", "e f  g", "a b e"):
        assert encoder.encode([text])[0].tolist() == library_ids(BYTE, text)


def naive_level(counts, size, window):
    """The level by recomputing the whole sum of squares for each choice."""
    best = None
    for h in range(window - size, -1, -1):
        if h and not counts[h]:
            continue
        after = counts.copy()
        if h:
            after[h] -= 1
        if h + size < window:
            after[h + size] += 1
        cost = int((after[1:window] ** 2).sum())
        if best is None or cost < best[0]:
            best = (cost, h)
    return best[1]


def test_levels_minimise_the_sum_of_squares():
    rng = np.random.default_rng(1)
    levels = packing.SumOfSquares(24)
    for _ in range(600):
        size = int(rng.integers(1, 24))
        assert levels.level(size) == naive_level(levels.counts, size, 24)
        levels.add((0, 0, size))
        assert all(len(own) == n for own, n in zip(levels.open, levels.counts[:24], strict=True))


def test_closing_leaves_one_open_window():
    rng = np.random.default_rng(2)
    levels, total, full = packing.SumOfSquares(64), 0, []
    for i in range(500):
        size = int(rng.integers(1, 64))
        total += size
        full += [own] if (own := levels.add((i, 0, size))) else []
    windows = full + list(levels.close())
    sizes = [sum(n for _, _, n in own) for own in windows]
    assert sum(sizes) == total and sum(s < 64 for s in sizes) <= 1 and max(sizes) <= 64


def test_padding_rule():
    assert [packing.padding(n) for n in (1, 2, 3, 2_048, 2_049, 4_096)] == [0, 0, 4_093, 0, 2_047, 0]


def check_pieces(rows, docs, window):
    """Every id of every document in one piece; sequences gapless and never too long."""
    left = {}
    for r in rows:
        left.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = [(i, np.array([*library_ids(WORD, t), 2], dtype="<u4")) for i, t in docs]
    total = sum(len(ids) for _, ids in want)
    assert sum(r.length for r in rows) == total == sum(len(r.ids) // 4 for r in rows)
    for i, ids in want:
        own = sorted(left[i, len(ids)], key=lambda r: r.start)
        for r in own:
            if bytes(r.ids) == ids[r.start : r.start + r.length].tobytes():
                continue
            raise AssertionError((i, r.start))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= window
    return sequences


def test_packing_of_documents(docs):
    rng = np.random.default_rng(3)
    pairs = [(i, " ".join(f"w{k}" for k in rng.integers(0, 50, int(rng.integers(0, 90))))) for i in range(120)]
    rows = packing.pack(docs(pairs).repartition(3), WORD, window=64).collect()
    sequences = check_pieces(rows, pairs, 64)
    short = [own for own in sequences.values() if sum(n for _, n in own) < 64]
    assert len(short) <= 3


def test_packing_of_odd_rows(odd, docs):
    rows = packing.pack(odd, WORD).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd.collect()], 4_096)
    assert packing.pack(docs([]), WORD).collect() == []


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1_000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    planes = bitplanes.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4) and bitplanes.from_planes(planes, n).tolist() == ids.tolist()
    shard = bitplanes.encode_shard(ids, 100, bits)
    assert bitplanes.decode_shard(n, *shard).tolist() == ids.tolist()
    if n:
        k = (n - 1) // 100
        assert bitplanes.read_block(k, n, *shard).tolist() == ids[100 * k :].tolist()


def read_back(df, path, **rule):
    bitplanes.write_tokens(df, path, BYTE, **rule)
    return bitplanes.read_tokens(df.sparkSession, path).orderBy("start").collect()


@pytest.mark.parametrize("rule", [{}, {"block": 16, "shard_ids": 50, "bits": True}])
def test_token_file_round_trip(docs, tmp_path, rule):
    pairs = [((7 * i) % 41, f"text number {i} " * (i % 9)) for i in range(41)]
    rows = read_back(docs(pairs).repartition(4), str(tmp_path / "t"), **rule)
    at = 0
    for r, (i, text) in zip(rows, sorted(pairs), strict=True):
        ids = np.array([*library_ids(BYTE, text), 2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_file_of_odd_rows(odd, docs, tmp_path):
    rows = read_back(odd, str(tmp_path / "t"))
    want = sorted((([r.doc_id is not None, r.doc_id or 0]), [*library_ids(BYTE, r.text), 2]) for r in odd.collect())
    got = sorted(([r.doc_id is not None, r.doc_id or 0], np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert got == want
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows[:-1])]).tolist()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    assert read_back(docs([]), str(tmp_path / "empty")) == []
