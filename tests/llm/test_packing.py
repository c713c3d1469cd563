import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from epicentre.llm import packing as p


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(p.default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(df, tokenizer):
    rows = p.packed_pieces(df).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    texts = defaultdict(list)
    for r in df.collect():
        texts[r.doc_id].append(r.text)
    assert set(pieces) == set(texts)
    for i, mine in pieces.items():
        if len(texts[i]) > 1:
            continue
        ids, at = ids_of(tokenizer, texts[i][0]), 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    fill = [sum(r.length for r in x) for x in sequences.values()]
    return sum(fill), sum(4096 - f for f in fill if f & (f - 1))


def test_round_trip_and_padding(sf001_docs, tokenizer):
    used, padded = check(sf001_docs, tokenizer)
    assert padded <= 0.02 * used


def test_odd_inputs(odd_docs, clash, docs_of, tokenizer):
    check(odd_docs, tokenizer)
    check(clash(odd_docs), tokenizer)
    assert p.packed_pieces(docs_of([])).collect() == []


def test_repeated_rows_are_packed_each(docs_of):
    assert p.packed_pieces(docs_of([(1, "a b c")] * 3)).count() == 3


@pytest.mark.parametrize("text", ["Thing, THING. thing's I'LL", "á ́b c\x1cd", "ΣΑΣ Σ İ ﬁ 3½ x2.", "<|startoftext|>a <|endoftext|>.", "don't.stop,now a.b", ". , .. ,,", "a.\tB,\x0bc\r\nD"])
def test_string_by_string_is_the_same(text, tokenizer):
    flat, counts = p.encode(pa.array([text, None, text]), p.default_tokenizer())
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert flat.tolist() == want * 2 and counts.tolist() == [len(want), 0, len(want)]


def test_shortcuts_are_taken_only_where_they_hold():
    import public_tokenizers

    own, other = p._Ids(p.default_tokenizer()), p._Ids(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.by_words and own.plain and own.direct
    assert not (other.by_words or other.plain or other.direct)


def _saved(tmp_path, pre, normalizer=None, added=()):
    """A small tokenizer of words, for the shortcuts between all and none."""
    from tokenizers import AddedToken, Tokenizer, models

    names = ["<unk>", "the", "The", ".", ",", "a", "A", "cat", "of", "the."]
    t = Tokenizer(models.WordLevel({w: k for k, w in enumerate(names)}, unk_token="<unk>"))
    t.pre_tokenizer = pre
    if normalizer is not None:
        t.normalizer = normalizer
    t.add_tokens([AddedToken(x) for x in added])
    t.save(str(tmp_path / "t.json"))
    return str(tmp_path / "t.json")


@pytest.mark.parametrize("added", [(), ("cat",), ("of the",)])
@pytest.mark.parametrize("kind", ["blanks", "lower"])
def test_other_tokenizers(kind, added, tmp_path):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    path = _saved(tmp_path, pre_tokenizers.WhitespaceSplit() if kind == "blanks" else pre_tokenizers.BertPreTokenizer(), normalizers.Lowercase() if kind == "lower" else None, added)
    texts = ["The cat. the, THE of the", "A  a\tcat\n.", "", "Cat cat, the. ofthe of  the"]
    flat, counts = p.encode(pa.array(texts), path)
    want = [Tokenizer.from_file(path).encode(x, add_special_tokens=False).ids for x in texts]
    assert flat.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    assert p._Ids(path).plain == (kind == "lower" and not added)


def test_whole_texts_with_a_tokenizer_that_keeps_blanks(sf001_docs, odd_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for df in (sf001_docs.limit(40), odd_docs.where("doc_id <> 5")):
        docs = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
        got = defaultdict(list)
        for r in p.pack(df, tokenizer=path, end_id=50256).collect():
            if r.doc_id is not None:
                got[r.doc_id].append((r.start, r.ids))
        assert set(got) == set(docs)
        for i, x in docs.items():
            ids = np.frombuffer(b"".join(b for _, b in sorted(got[i])), "<u4").tolist()
            assert ids == [*t.encode(x or "", add_special_tokens=False).ids, 50256]


def test_forgetting_changes_nothing(monkeypatch, sf001_docs, tokenizer):
    monkeypatch.setattr(p, "CACHE", 5)
    p._stores.clear()
    texts = [r.text for r in sf001_docs.limit(20).collect()]
    for t in texts:
        assert p.encode(pa.array([t]), p.default_tokenizer())[0].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    p._stores.clear()


def test_best_fit_matches_a_plain_search():
    rng = random.Random(5)
    for _ in range(30):
        lengths = np.array([rng.randint(1, 63) for _ in range(rng.randint(0, 60))], dtype=np.int64)
        where, offset, filled = p.best_fit(lengths, 64)
        free = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                free.remove(min(fits))
                room = min(fits)
            else:
                room = 64
            assert offset[i] == 64 - room
            free.append(room - lengths[i])
        assert sorted(64 - f for f in free) == sorted(filled)


def test_blocks_pack_whole_documents():
    n = np.array([0, 1, 5, 64, 65, 200, 3, 128, 7])
    doc, start, length, seq, offset, at = p.pack_block(n, 64, 0.9, 10)
    assert np.bincount(doc, weights=length, minlength=9).tolist() == n.tolist()
    fill = np.bincount(seq - 10, weights=length)
    assert fill.max() <= 64 and at == seq.max() + 1
    assert all(f >= 0.9 * 64 or int(f) & (int(f) - 1) == 0 for f in fill if f)
