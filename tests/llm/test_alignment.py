"""Token alignment against the tokenizers' libraries and plain loops over byte ranges."""

import hashlib
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quern.llm import alignment, bpe
from quern.llm.queries import BYTE_BPE, PIECES
from tests.llm.test_operators import SCHEMA, TEXTS, rows

MORE = ["a ▁ b", "  two  spaces ", "<s> <0x41> </s> <unk>", "\ta\r\n\r\nb\x00", "é é ﬁ ² 中 ﷽", " ", "   ", "the " * 400]
BYTE_OF = {c: b for b, c in enumerate(bpe.byte_symbols())}


def sides(text):
    """Ids and bytes of both sides as the libraries give them."""
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    if not text:
        return [], []
    x = [(i, bytes(BYTE_OF[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (x, y) if b"".join(r for _, r in x) == whole == b"".join(r for _, r in y) else ([], [])


def spans(side):
    out, at = [], 0
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def links(x, y):
    return [(i, j) for i, p, q in x for j, r, s in y if p < s and r < q]


def groups(x, y):
    ends = sorted({q for _, _, q in x} & {q for _, _, q in y})
    out, low = [], 0
    for e in ends:
        out.append(",".join(str(i) for i, p, _ in x if low <= p < e) + "|" + ",".join(str(i) for i, p, _ in y if low <= p < e))
        low = e
    return out


def test_alignment(spark):
    given = [*rows(), *((100 + k, t, "en", "s", 1, 1, 1, "k", "z") for k, t in enumerate(MORE))]
    given = [r for r in given if not r[1] or len(r[1]) < 3000]
    got = alignment.aligned(spark.createDataFrame(given, SCHEMA).repartition(3), BYTE_BPE, PIECES).collect()
    assert len(got) == len(given)
    docs = [(r[0], *(spans(s) for s in sides(r[1]))) for r in given]
    count = Counter(pair for _, x, y in docs for pair in set(links(x, y)))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    want = []
    for i, x, y in docs:
        tied = links(x, y)
        want.append((i, len(x), len(y), len(groups(x, y)), len(tied), sum(count[p] == top[p[0]] for p in tied), sum(count[p] for p in tied), ";".join(groups(x, y))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(i == 100 and not n for i, n, *_ in want)  # the mark for spaces as a letter: not given back


def test_digest_and_no_rows(spark):
    df = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    a, b = alignment.alignment_digests(df, BYTE_BPE, PIECES).orderBy("doc_id").collect()
    text = alignment.aligned(df, BYTE_BPE, PIECES).where("doc_id = 1").first().groups
    assert a.groups_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert b.groups_sha256 == "" and b.n_links == 0
    assert alignment.alignment_digests(df.where("doc_id > 9"), BYTE_BPE, PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), unique=True, max_size=400), st.lists(st.integers(0, 5000), unique=True, max_size=400))
def test_gallop(a, b):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    assert alignment.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_cached_pieces_are_the_librarys():
    lib, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), alignment.Pieces(PIECES)
    assert own.apart
    for t in [*MORE, *(t for t in TEXTS if t)]:
        packed = own.encode(t)
        assert (packed is None) == ("▁" in t)
        assert packed is None or np.frombuffer(packed, own.kind).tolist() == lib.encode(t)
