from __future__ import annotations

import pytest

from llm.invented import prose
from shelfcast.llm.pieces import BYTE_SCORE, LONG, MODEL, decode_ids, encode_texts, pieces_of, words_with_blanks

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [
    "", " ", "  a  b ", "\n\n x\t", "🙂 emoji 汉字 €", "a" * (LONG + 200), "x y" * 50 + "é" * 100, "</s> <s> <0x41> <unk>", "▁under ▁", "\x00\x01", "Hello, world!  This is   it.", prose(1, 300),
    "the " * 30, "ﬁne ½ ＡＢ", "é", "tion" * 40, "日本語" * 50,
]


@pytest.fixture(scope="module")
def scores():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return {model.id_to_piece(i).replace("▁", " "): (i, max(-1e5, model.get_score(i))) for i in usable}


def best(text, scores, byte_id):
    """The whole text in one go, place by place."""
    total, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        raw = text[end - 1].encode()
        total.append(total[end - 1] + BYTE_SCORE * len(raw))
        back.append((end - 1, [int(byte_id[b]) for b in raw]))
        for length in range(1, min(16, end) + 1):
            piece = scores.get(text[end - length : end])
            if piece and total[end - length] + piece[1] >= total[end]:
                total[end], back[end] = total[end - length] + piece[1], (end - length, [piece[0]])
    ids, at = [], len(text)
    while at:
        at, some = back[at]
        ids = some + ids
    return ids


def test_best_and_back(scores):
    pieces = pieces_of(MODEL)
    ids = pieces.encode([*TEXTS, None])
    assert pieces.decode(ids).to_pylist() == [*TEXTS, None]
    for text, got in zip(TEXTS, ids.to_pylist()):
        assert got == best(text, scores, pieces.byte_id)


def test_words():
    for text in TEXTS:
        assert "".join(words_with_blanks(text)) == text


def test_odd_rows(odd_docs, no_docs):
    for r in decode_ids(encode_texts(odd_docs, to="numbers"), "numbers", to="again").collect():
        assert r["again"] == r["text"] and (r["numbers"] is None) == (r["text"] is None)
    assert decode_ids(encode_texts(no_docs, to="numbers"), "numbers").count() == 0
