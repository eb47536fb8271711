"""Byte-level BPE encoding and decoding with a public vocabulary of ranks.

The ``tokenizers`` library does the merging, inside tasks, over Arrow batches. Its model knows
characters, not bytes, so every byte has a character of its own (the byte table below), and the
merges are derived from the ranks. Decoding turns ids back to bytes by the reversed table; a
character that is split over several tokens is whole again once its bytes are joined.

A text is cut by the split pattern into pieces that are encoded separately. Corpora repeat
their pieces, so a task keeps the ids of the pieces it has met, up to a bound, and hands only new
ones to the library. Where a blank or a line feed stands alone between two other characters the
pattern always cuts before the blank and around the line feed; such texts are first cut there,
which saves the pattern for the stretches that are new.

Defined results
    null and empty texts: no ids, decoded to nothing. Repeated rows: encoded one by one. Empty
    table: no rows. Other columns are kept, whatever their names. Texts of any length are encoded
    whole; the pieces of a text are independent, so its length costs only its own memory.
"""

import base64
import codecs
import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F, types as T

from microtally.llm.registry import in_batches, query, read

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# Pieces, and stretches between blanks, of which a task remembers the ids.
MEMORY = 600_000
# Characters of what is remembered; beyond either bound a task forgets and starts again.
MEMORY_CHARS = 16_000_000
# Rows handed to Python at once.
BATCH_ROWS = 256

# White space side by side, characters that leave the quick cut to the pattern, and a blank with
# other characters on both sides.
CROWDED = ("  ", " \n", "\n ", "\n\n")
RARE = re.compile("[\x00\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LONE_BLANK = re.compile(r"(?<=\S)(?= \S)")
# A word in Latin letters and the marks behind it: two matches of the pattern.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?#$%&*|-]*)")


def byte_characters():
    """The character that stands for each byte: itself if it is printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    table = {byte: chr(byte) for byte in printable}
    table.update({byte: chr(0x100 + place) for place, byte in enumerate(others)})
    return [table[byte] for byte in range(256)]


def read_ranks(content):
    """Token bytes and ranks from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def merge_pair(token, ranks):
    """The two tokens whose merge gives ``token``: what is left of its bytes after all earlier merges."""
    parts = [bytes([byte]) for byte in token]
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Encoder and decoder for one vocabulary; holds what is remembered of earlier texts."""

    def __init__(self, content, pattern=PATTERN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(content)
        character = byte_characters()
        written = lambda token: "".join(character[byte] for byte in token)
        by_rank = sorted(ranks, key=ranks.get)
        merges = [tuple(map(written, merge_pair(token, ranks))) for token in by_rank if len(token) > 1]
        self.model = Tokenizer(models.BPE(vocab={written(token): ranks[token] for token in by_rank}, merges=merges))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cutter = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.tokens = {ranks[token]: token for token in by_rank}
        self.characters = {ranks[token]: written(token) for token in by_rank}
        self.lengths = np.zeros(max(self.tokens, default=0) + 1, dtype=np.int64)
        self.lengths[list(self.tokens)] = [len(token) for token in self.tokens.values()]
        self.reversed = np.zeros(max(map(ord, character)) + 1, dtype=np.uint8)
        self.reversed[[ord(each) for each in character]] = range(256)
        self.names = {rank: str(rank) for rank in self.tokens}
        self.known, self.held = {"": ()}, 0

    def _pieces(self, stretch):
        """The matches of the pattern in a stretch; a word with or without marks behind it is plain to see."""
        plain = PLAIN.fullmatch(stretch)
        if plain is None:
            return [piece for piece, _ in self.cutter.pre_tokenize_str(stretch)]
        word, marks = plain.groups()
        return (word, marks) if marks else (word,)

    def _learn(self, stretches):
        """Remembers the ids of stretches not met before; all new pieces go to the library at once."""
        cut = {stretch: self._pieces(stretch) for stretch in stretches}
        new = list({piece for pieces in cut.values() for piece in pieces}.difference(self.known))
        if new:
            encoded = self.model.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids, owner = encoded.ids, np.array(encoded.word_ids)
            edges = np.searchsorted(owner, np.arange(len(new) + 1)).tolist()
            for piece, start, end in zip(new, edges, edges[1:]):
                self.known[piece] = tuple(ids[start:end])
        for stretch, pieces in cut.items():
            if stretch not in self.known:
                self.known[stretch] = tuple(chain.from_iterable(map(self.known.__getitem__, pieces)))
        self.held += sum(map(len, cut))

    def encode(self, texts):
        """Ids of each text, as lists; exactly those of encoding each match of the pattern."""
        if len(self.known) > MEMORY or self.held > MEMORY_CHARS:
            self.known = {"": ()}
            self.held = 0
        plain = [self._stretches(text) for text in texts]
        new = set(chain.from_iterable(plain)).difference(self.known)
        if new:
            self._learn(new)
        known = self.known.__getitem__
        return [list(chain.from_iterable(map(known, stretches))) for stretches in plain]

    @staticmethod
    def _stretches(text):
        """Cuts a text where the pattern is sure to cut; the stretches joined are the text."""
        if not text:
            return []
        if text[0] in " \n" or text[-1] in " \n" or any(pair in text for pair in CROWDED) or RARE.search(text):
            return LONE_BLANK.split(text)
        return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")

    def decode(self, ids):
        """The bytes of a list of ids: their characters through the reversed byte table."""
        characters = "".join(map(self.characters.__getitem__, ids))
        return self.reversed[np.frombuffer(characters.encode("utf-16-le"), dtype="<u2")].tobytes()

    def decode_pieces(self, ids):
        """The text each token completes: bytes of a split character wait for the token that ends it."""
        decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
        out = [decoder.decode(self.decode((id,))) for id in ids]
        if out:
            out[-1] += decoder.decode(b"", final=True)
        return out

    def edges(self, ids, text):
        """Starts and ends of the tokens in characters of the text, as arrays; a split character is in all its tokens."""
        whole = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((whole & 0xC0) != 0x80) - 1
        lengths = self.lengths[np.array(ids, dtype=np.int64)]
        ends = np.cumsum(lengths)
        return character[ends - lengths].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)

    def offsets(self, ids, text):
        """Start and end of each token, as pairs."""
        starts, ends = self.edges(ids, text)
        return list(zip(starts.tolist(), ends.tolist()))

    def written(self, ids):
        """Decimal ids joined by one blank."""
        return " ".join(map(self.names.__getitem__, ids))


def _low_first(numbers):
    return numbers.astype("<i4").tobytes()


@lru_cache(maxsize=2)
def _coder(content, pattern):
    """One encoder per worker process and vocabulary."""
    return ByteBpe(content, pattern)


def _vocabulary(spark, path):
    """The rank file, sent to every worker once; refused above 64 MB."""
    with open(path, "rb") as file:
        content = file.read(64 << 20)
        if file.read(1):
            raise ValueError(f"{path} is too large for a vocabulary of ranks")
    return spark.sparkContext.broadcast(content)


def tokenize(docs, text="text", vocabulary=VOCABULARY, pattern=PATTERN, offsets=False, digests=False, into="tokens"):
    """The rows of ``docs`` with a struct ``into``: ``ids`` and, if asked, where the tokens start and end in characters,
    and the SHA-256 of the decoded bytes."""
    spark = docs.sparkSession
    in_batches(spark, BATCH_ROWS)
    content = _vocabulary(spark, vocabulary)
    kind = "ids array<int>" + ", starts array<int>, ends array<int>" * offsets + ", decoded_sha256 string" * digests

    @F.pandas_udf(kind)
    def encode(texts: pd.Series) -> pd.DataFrame:
        coder = _coder(content.value, pattern)
        values = ["" if value is None else value for value in texts]
        ids = coder.encode(values)
        out = {"ids": [np.array(each, dtype=np.int32) for each in ids]}
        if offsets:
            edges = [coder.edges(each, value) for each, value in zip(ids, values)]
            out["starts"] = [starts for starts, _ in edges]
            out["ends"] = [ends for _, ends in edges]
        if digests:
            out["decoded_sha256"] = [hashlib.sha256(coder.decode(each)).hexdigest() for each in ids]
        return pd.DataFrame(out)

    return docs.select(*[F.col(f"`{name}`") for name in docs.columns], encode(F.col(text)).alias(into))


def detokenize(tokens, ids="ids", vocabulary=VOCABULARY, into="text"):
    """The rows of ``tokens`` with the text of their ids; bytes that are no UTF-8 become U+FFFD."""
    spark = tokens.sparkSession
    in_batches(spark, BATCH_ROWS)
    content = _vocabulary(spark, vocabulary)

    @F.pandas_udf("string")
    def decode(lists: pd.Series) -> pd.Series:
        coder = _coder(content.value, PATTERN)
        return pd.Series(["" if each is None else coder.decode(each).decode("utf-8", "replace") for each in lists], dtype=object)

    return tokens.select(*[F.col(f"`{name}`") for name in tokens.columns], decode(F.col(ids)).alias(into))


DIGESTS = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()), T.StructField("offsets_sha256", T.StringType()),
])


def token_digests(docs, text="text", vocabulary=VOCABULARY, pattern=PATTERN, into="digests"):
    """The rows of ``docs`` with a struct ``into``: number of ids and digests of the ids, of the decoded
    bytes, and of the starts, then the ends, of the tokens in characters (four bytes each, low byte first)."""
    spark = docs.sparkSession
    in_batches(spark, BATCH_ROWS)
    content = _vocabulary(spark, vocabulary)

    @F.pandas_udf(DIGESTS)
    def digest(texts: pd.Series) -> pd.DataFrame:
        coder = _coder(content.value, pattern)
        rows = []
        values = ["" if value is None else value for value in texts]
        for ids, value in zip(coder.encode(values), values):
            rows.append((len(ids), hashlib.sha256(coder.written(ids).encode()).hexdigest(),
                         hashlib.sha256(coder.decode(ids)).hexdigest(), hashlib.sha256(b"".join(map(_low_first, coder.edges(ids, value)))).hexdigest()))
        return pd.DataFrame(rows, columns=DIGESTS.names)

    return docs.select(*[F.col(f"`{name}`") for name in docs.columns if name != text], digest(F.col(text)).alias(into))


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    """All documents with their number of tokens and the digests of ids, decoded bytes and offsets."""
    found = token_digests(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "digests.*")
