import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from microtally.llm import byte_bpe, operators  # noqa: F401
from microtally.llm.registry import QUERIES
from tests.llm.cases import AWKWARD, SF_DIR, awkward, clashing, table


@pytest.fixture(scope="module")
def other():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(byte_bpe.VOCABULARY, "rb") as file:
        return byte_bpe.ByteBpe(file.read())


def digests(other, text):
    ids = other.encode_ordinary(text or "")
    spans = plain_offsets(other, ids)
    places = b"".join(n.to_bytes(4, "little") for column in (0, 1) for n in (span[column] for span in spans))
    return (len(ids), *(hashlib.sha256(part).hexdigest() for part in (" ".join(map(str, ids)).encode(), (text or "").encode(), places)))


def plain_offsets(other, ids):
    """Start and end of each token in characters, byte by byte."""
    at, spans = -1, []
    for id in ids:
        places = []
        for byte in other.decode_single_token_bytes(id):
            at += byte & 0xC0 != 0x80
            places.append(at)
        spans.append((places[0], places[-1] + 1))
    return spans


WHITE = st.text(alphabet=" \n\t\r\x0b\x1c\x85  　ab.1'é\x00", max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.one_of(WHITE, st.text(max_size=60)))
def test_ids_are_those_of_the_other_library(other, coder, text):
    ids = coder.encode([text])[0]
    assert ids == other.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()
    assert "".join(coder.decode_pieces(ids)) == text
    assert coder.offsets(ids, text) == plain_offsets(other, ids)


def test_every_token_decodes_through_the_byte_table(other, coder):
    assert all(coder.decode([id]) == other.decode_single_token_bytes(id) for id in coder.tokens)
    assert coder.decode([]) == b"" and coder.decode_pieces([]) == []


@pytest.mark.parametrize("text", [
    "<|endoftext|> is ordinary", "it's they'll I'D", "a" * 20_000, " " * 5000 + "x", "x\n\n\n y \n z", "🙂" * 300, "é́", "\x00a b\x00",
    "Привет мир, 你好 世界"])
def test_particular_texts(other, coder, text):
    assert coder.encode([text])[0] == other.encode_ordinary(text)


def test_forgetting_changes_nothing(other, coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMORY", 5)
    texts = [row["text"] for row in table("documents")[:40]]
    assert [coder.encode([text])[0] for text in texts] == [other.encode_ordinary(text) for text in texts]


def test_offsets_of_split_characters(coder):
    text = "a 🙂b é"
    ids = coder.encode([text])[0]
    spans = coder.offsets(ids, text)
    for id, (start, end) in zip(ids, spans):
        assert coder.tokens[id] in text[start:end].encode()
    assert spans[0][0] == 0 and spans[-1][1] == len(text)


def test_whole_table(spark, other):
    found = {row.doc_id: tuple(row)[1:] for row in QUERIES["op5_byte_bpe"](spark, SF_DIR).collect()}
    assert found == {row["doc_id"]: digests(other, row["text"]) for row in table("documents")}


def test_awkward_rows(spark, other, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(repr(tuple(row)) for row in QUERIES["op5_byte_bpe"](spark, str(tmp_path)).collect())
    assert found == sorted(repr((row[0], *digests(other, row[1]))) for row in AWKWARD)


def test_there_and_back(spark):
    docs = clashing(awkward(spark))
    tokens = byte_bpe.tokenize(docs, offsets=True, digests=True, into="t$")
    assert tokens.columns == [*docs.columns, "t$"]
    back = byte_bpe.detokenize(tokens.select("doc_id", "text", "t$.ids"), into="again")
    assert all((row.text or "") == row.again for row in back.collect())
    assert byte_bpe.tokenize(awkward(spark, [])).count() == 0
