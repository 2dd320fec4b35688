"""Byte-level BPE over whole texts: a recursive DuckDB query in every partition.

Spark deals the documents; each task splits its texts with the tokenizer's pattern and hands the distinct words it has not
met yet to DuckDB. There a word is the list of its tokens. Each round unnests the lists to token-position rows,
joins neighbours with the merge table, finds each word's smallest rank, leftmost first, and contracts that pair, until no
word has a pair left. Decoding joins the tokens with the vocabulary and aggregates their bytes in order.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text whose words a task holds at once.
TEXT_BLOCK = 1 << 20

#: Characters of words given to one recursive query, and from which on a word is taken apart first.
WORD_BLOCK = 1 << 18
LONG_WORD = 64

#: Words a worker remembers in each of two generations.
REMEMBERED = 200_000

#: A place where a text can be cut without changing its words: one space between printable ASCII characters begins a
#: word.
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")

# Every round's rows are kept until the end, which is cheap for short words. A code is a rank in the upper half and a
# position in the lower one.
_ENCODE = """
WITH RECURSIVE step(word, tokens) AS (
  SELECT word, tokens FROM fresh
  UNION ALL
  (WITH pairs AS (
     SELECT word, unnest(range(1, len(tokens))) AS pos,
            unnest(tokens[:-2]) * 65536::BIGINT + unnest(tokens[2:]) AS pair
     FROM step),
   best AS (SELECT word, min(code + pos) AS code FROM pairs JOIN merges USING (pair) GROUP BY word)
   SELECT s.word,
          list_concat(list_append(tokens[:(code & 4294967295) - 1], (code >> 32)::INTEGER),
                      tokens[(code & 4294967295) + 2:])
   FROM step s JOIN best USING (word))
)
SELECT word, arg_min(tokens, len(tokens)) AS tokens FROM step GROUP BY word
"""

# The same for long words, keeping only the last round. A merged token is "steady" if every pair that contains it
# has a larger rank. Then contracting one occurrence cannot bring up a smaller pair, so a round contracts all
# occurrences that do not overlap, from the left, just as so many single rounds would.
_ENCODE_LONG = """
WITH RECURSIVE step(word, tokens) USING KEY (word) AS (
  SELECT word, tokens FROM fresh
  UNION
  (WITH pairs AS (
     SELECT word, unnest(range(1, len(tokens))) AS pos,
            unnest(tokens[:-2]) * 65536::BIGINT + unnest(tokens[2:]) AS pair
     FROM step),
   hits AS (SELECT word, pos, code >> 32 AS rank, steady, code + pos AS code FROM pairs JOIN merges USING (pair)),
   best AS (
     SELECT word, (min(code) >> 32)::INTEGER AS rank, min(code) & 4294967295 AS pos FROM hits GROUP BY word),
   runs AS (
     SELECT h.word, h.pos,
            h.pos - row_number() OVER (PARTITION BY h.word ORDER BY h.pos) AS run
     FROM hits h JOIN best b ON h.word = b.word AND h.rank = b.rank
     WHERE h.steady),
   alternate AS (
     SELECT word, pos, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS k FROM runs),
   several AS (
     SELECT word, list(pos) AS places FROM alternate WHERE k % 2 = 1
     GROUP BY word HAVING count(*) > 1)
   SELECT s.word,
          CASE WHEN places IS NULL THEN list_concat(list_append(tokens[:pos - 1], rank), tokens[pos + 2:])
          ELSE list_filter(
            list_transform(tokens, lambda t, i: CASE WHEN list_contains(places, i) THEN rank
                                                     WHEN list_contains(places, i - 1) THEN NULL
                                                     ELSE t END),
            lambda t: t IS NOT NULL) END
   FROM step s JOIN best USING (word) LEFT JOIN several USING (word))
)
SELECT word, tokens FROM step
"""

_DECODE = """
WITH rows AS (
  SELECT word, unnest(tokens) AS id, generate_subscripts(tokens, 1) AS pos FROM encoded)
SELECT word, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes
FROM rows JOIN vocabulary USING (id) GROUP BY word
"""


def read_ranks(text: bytes) -> dict[bytes, int]:
    """Rank of each token, from lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, text.splitlines())}


def merge_rows(ranks: dict[bytes, int]) -> pa.Table:
    """``pair, code, steady``: every split of a token into two tokens, the pair packed into one number, the rank in
    the upper half of the code."""
    left, right, rank = [], [], []
    for token, merged in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), rank.append(merged)
    a, b, c = (np.array(x, np.int64) for x in (left, right, rank))
    smallest = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, a, c)
    np.minimum.at(smallest, b, c)
    return pa.table({"pair": a * 65536 + b, "code": c << 32, "steady": smallest[c] > c})


class Encoder:
    """Words to tokens and back, with the two generations of words it met last."""

    def __init__(self, text: bytes) -> None:
        self.ranks = read_ranks(text)
        if max(self.ranks.values()) >= 65536 or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("ranks need every single byte and ids below 65,536")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        merges = merge_rows(self.ranks)
        vocabulary = pa.table({"id": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]})
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT id::INTEGER AS id, hex FROM vocabulary")
        self.recent: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.finder: ahocorasick.Automaton | None = None

    def learn(self, words: set[str]) -> None:
        """Make sure that every word is remembered."""
        new = words - self.recent.keys()
        known = new & self.older.keys()
        self.recent.update((word, self.older[word]) for word in known)
        block, size = [], 0
        for word in new - known:
            if len(word) > LONG_WORD:
                self.recent[word] = self._long(word.encode("utf-8"))
                continue
            block.append(word)
            size += len(word)
            if size >= WORD_BLOCK:
                self._learn_short(block)
                block, size = [], 0
        if block:
            self._learn_short(block)

    def _learn_short(self, words: list[str]) -> None:
        pieces = [word.encode("utf-8") for word in words]
        self.recent.update(zip(words, self._encoded(pieces, _ENCODE), strict=True))

    def _long(self, piece: bytes) -> tuple[bytes, bytes]:
        """A long word by its parts. Words of any length come apart into parts as short as other words, mostly."""
        if piece in self.ranks:
            return self._encoded([piece], _ENCODE)[0]
        parts = self._apart(piece)
        found: dict[bytes, tuple[bytes, bytes]] = {}
        block, size = [], 0
        for part in dict.fromkeys(parts):
            if len(part) > LONG_WORD:
                found[part] = self._encoded([part], _ENCODE_LONG, whole=False)[0]
                continue
            block.append(part)
            size += len(part)
            if size >= WORD_BLOCK:
                found.update(zip(block, self._encoded(block, _ENCODE, whole=False), strict=True))
                block, size = [], 0
        if block:
            found.update(zip(block, self._encoded(block, _ENCODE, whole=False), strict=True))
        return b"".join(found[part][0] for part in parts), b"".join(found[part][1] for part in parts)

    def _apart(self, piece: bytes) -> list[bytes]:
        """The parts between the places that no token of the vocabulary lies across, wherever it occurs.

        Every token that merging makes is one that occurs there, so nothing is ever merged across such a place, and the
        parts can be merged apart from each other.
        """
        if self.finder is None:
            self.finder = ahocorasick.Automaton()
            for token in self.ranks:
                if len(token) > 1:
                    self.finder.add_word(token.decode("latin-1"), len(token))
            self.finder.make_automaton()
        across = np.zeros(len(piece) + 1, np.int64)
        found = np.array(list(self.finder.iter(piece.decode("latin-1"))), np.int64).reshape(-1, 2)
        np.add.at(across, found[:, 0] - found[:, 1] + 2, 1)
        np.add.at(across, found[:, 0] + 1, -1)
        cuts = [0, *(np.flatnonzero(np.cumsum(across)[1:-1] == 0) + 1).tolist(), len(piece)]
        return [piece[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def forget(self) -> None:
        """Drop the words not met since the last generation once there are enough of new ones."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent

    def _encoded(self, pieces: list[bytes], query: str, whole: bool = True) -> list[tuple[bytes, bytes]]:
        """The packed tokens of each piece and what they decode to. With ``whole`` a piece that is a token is that token."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        if whole:
            # Of a piece that is a token one place stays, which takes the token.
            rank = np.fromiter((self.ranks.get(piece, -1) for piece in pieces), np.int32, len(pieces))
            start = np.cumsum(lengths) - lengths
            is_token = rank >= 0
            stays = np.repeat(~is_token, lengths)
            stays[start[is_token]] = True
            tokens[start[is_token]] = rank[is_token]
            tokens, lengths = tokens[stays], np.where(is_token, 1, lengths)
        offsets = np.zeros(len(pieces) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))
        number = pa.array(np.arange(len(pieces), dtype=np.int32))
        db = self.db
        db.register("given", pa.table({"word": number, "tokens": lists}))
        db.execute("CREATE OR REPLACE TEMP TABLE fresh AS SELECT * FROM given")
        db.execute(f"CREATE OR REPLACE TEMP TABLE encoded AS {query}")
        ids = db.sql("SELECT tokens FROM encoded ORDER BY word").to_arrow_table()["tokens"].combine_chunks()
        decoded = db.sql(f"{_DECODE} ORDER BY word").to_arrow_table()["bytes"].to_pylist()
        db.unregister("given")
        ends = (4 * ids.offsets.to_numpy()).tolist()
        packed = ids.values.to_numpy().astype("<i4").tobytes()
        if not len(pieces) == len(ids) == len(decoded):
            raise RuntimeError("a word was lost")
        return [(packed[a:b], text) for a, b, text in zip(ends, ends[1:], decoded, strict=False)]


_encoders: dict[int, Encoder] = {}


def _encoder(text: bytes) -> Encoder:
    key = hash(text)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(text)
    return _encoders[key]


def blocks(text: str, size: int = TEXT_BLOCK) -> Iterator[str]:
    """A text in pieces of about ``size`` characters whose words are the words of the text."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _encode_batches(
    batches: Iterable[pa.RecordBatch], ranks: bytes, pattern: str, text_block: int = TEXT_BLOCK
) -> Iterator[pa.RecordBatch]:
    encoder, find = _encoder(ranks), regex.compile(pattern).findall

    def finished(keys: pa.Array, docs: list[list[tuple[bytes, bytes]]]) -> pa.RecordBatch:
        ids = [b"".join(map(itemgetter(0), doc)) for doc in docs]
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
        decoded = [b"".join(map(itemgetter(1), doc)) for doc in docs]
        lists = pa.ListArray.from_arrays(pa.array(offsets), values)
        return pa.RecordBatch.from_arrays(
            [keys, lists, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
        )

    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        first, docs, waiting, size = 0, [], [], 0

        def look_up() -> None:
            """Encode the waiting words and give each document its tokens."""
            encoder.learn(set().union(*[words for _, words in waiting]))
            for number, words in waiting:
                docs[number - first].extend(map(encoder.recent.__getitem__, words))
            waiting.clear()
            encoder.forget()

        for row in range(batch.num_rows):
            docs.append([])
            for piece in blocks(texts[row].as_py() or "", text_block):
                waiting.append((row, find(piece)))
                size += len(piece)
                if size >= text_block:
                    look_up()
                    size = 0
                    if len(docs) > 1:
                        yield finished(keys[first:row], docs[:-1])
                        first, docs = row, docs[-1:]
        look_up()
        yield finished(keys[first:], docs)


def byte_bpe(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, ids, decoded`` for every row: the tokens of its text and the bytes that they decode to.

    ``ranks_path`` names a file of base64 tokens and ranks that the driver can read (at most 65,536 tokens, so it is
    broadcast), ``pattern`` the expression whose matches are encoded one by one. A match that is a token is that token;
    others are merged from bytes, smallest rank first, leftmost on ties. Null texts are empty and give no tokens.
    Repeated rows give repeated results, a null id stays null, an empty table gives none, other columns are ignored.

    Nothing is shuffled. A task holds the words of one block of text and a bounded number of remembered words.
    """
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encode_batches(batches, ranks.value, pattern)

    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def token_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space, in lower-case hex."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)
