"""Encoding a corpus with a public byte-level BPE vocabulary.

Each partition keeps a small in-memory DuckDB. The distinct words of a batch become token-position rows; a
recursive query joins neighbouring rows with the merge table and contracts, in every word, the pair of least
rank until no pair is left, and an ordered aggregation turns the rows back into one list of ids per word.
A round contracts all non-overlapping places of the word's least pair, from the left. That equals contracting
them one by one: a merge's product is younger than the merge, so no contraction can create a pair of lower rank.
Long words are contracted in pieces, which are joined where that changes nothing.
The vocabulary's path is a parameter; the file is read by the workers and never shipped with the code.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.session import spread

#: words of one recursive query; bounds DuckDB's memory in a task
WORDS_A_QUERY = 20_000
#: rows of one recursive query; with LONG this bounds the rows of all its rounds
ROWS_A_QUERY = 200_000
#: bytes above which a word is contracted in pieces, and of a piece
LONG, PIECE = 128, 64
#: words remembered by a task; beyond that it forgets all and goes on
REMEMBERED_WORDS = 300_000

_CONTRACT = """
WITH RECURSIVE state(step, wid, pos, tok) AS (
  SELECT 0, wid, pos, tok FROM base
  UNION ALL
  SELECT step + 1, wid, pos, CASE WHEN chosen THEN new ELSE tok END
  FROM (
    SELECT *, coalesce(lag(chosen) OVER (PARTITION BY wid ORDER BY pos), false) AS eaten
    FROM (
      SELECT *, hit AND (tok <> nxt OR (row_number() OVER (PARTITION BY wid, hit, run ORDER BY pos)) % 2 = 1) AS chosen
      FROM (
        SELECT *, CASE WHEN hit AND tok = nxt THEN nr - row_number() OVER (PARTITION BY wid, hit ORDER BY pos) ELSE 0 END AS run
        FROM (
          SELECT *, coalesce(rank = best, false) AS hit
          FROM (
            SELECT *, min(rank) OVER (PARTITION BY wid) AS best
            FROM (
              SELECT s.*, m.rank, m.new
              FROM (SELECT step, wid, pos, tok, lead(tok) OVER w AS nxt, row_number() OVER w AS nr FROM state WINDOW w AS (PARTITION BY wid ORDER BY pos)) s
              LEFT JOIN merges m ON m.a = s.tok AND m.b = s.nxt
            )
          )
          WHERE best IS NOT NULL
        )
      )
    )
  )
  WHERE NOT eaten
)
SELECT wid, list(tok ORDER BY pos) AS ids
FROM (SELECT * FROM state QUALIFY step = max(step) OVER (PARTITION BY wid))
GROUP BY wid
"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _characters_of_bytes() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Contractor:
    """Words to ids by DuckDB; one per task. ``path`` names a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        import duckdb
        import public_tokenizers
        import regex

        model = json.loads(open(path, encoding="utf-8").read())["model"]
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        byte_of = {c: b for b, c in enumerate(_characters_of_bytes())}
        self.byte_ids = np.array([ids[c] for c in _characters_of_bytes()], dtype=np.int32)
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.bytes_of = {i: bytes(byte for c in t if (byte := byte_of.get(c)) is not None) for t, i in ids.items()}
        self.known: dict[bytes, np.ndarray] = {}
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "600MB", "temp_directory": "", "preserve_insertion_order": "false"})
        merges = pd.DataFrame({"a": [ids[a] for a, _ in pairs], "b": [ids[b] for _, b in pairs], "new": [ids[a + b] for a, b in pairs], "rank": range(len(pairs))}).astype("int32")
        self.db.register("merges_frame", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_frame")
        self.db.unregister("merges_frame")

    def _contract(self, words: list[bytes]) -> None:
        raw = [np.frombuffer(w, dtype=np.uint8) for w in words]
        sizes = np.array([len(x) for x in raw])
        pos = np.arange(sizes.sum(), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
        base = pd.DataFrame({"wid": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos, "tok": self.byte_ids[np.concatenate(raw)]})
        self.db.register("base", base)
        for wid, ids in self.db.execute(_CONTRACT).fetchall():
            self.known[words[wid]] = np.array(ids, dtype=np.int32)
        self.db.unregister("base")

    def learn(self, words: Iterable[bytes]) -> None:
        some, rows = [], 0
        for w in words:
            if w in self.known:
                continue
            if some and (len(some) >= WORDS_A_QUERY or rows + len(w) > ROWS_A_QUERY):
                self._contract(some)
                some, rows = [], 0
            some.append(w)
            rows += len(w)
        if some:
            self._contract(some)

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)

    def learn_long(self, words: list[bytes]) -> None:
        """Words of any length, from pieces that are joined where the two tokens at the joint stay apart when contracted together.

        A list of tokens is the contraction of its bytes if and only if every two neighbours are that of theirs.
        Where they are not, some tokens on both sides are contracted anew, more in every round.
        """
        if not words:
            return
        parts = {w: [w[i : i + PIECE] for i in range(0, len(w), PIECE)] for w in words}
        self.learn(dict.fromkeys(x for p in parts.values() for x in p))
        open_ = {w: [self.known[x] for x in p] for w, p in parts.items()}
        wide = 2
        while open_:
            joints = {w: [self._bytes((x[-1], y[0])) for x, y in zip(p, p[1:])] for w, p in open_.items()}
            self.learn(dict.fromkeys(j for js in joints.values() for j in js))
            again: dict[str, list] = {}
            for w, p in open_.items():
                done = [p[0]]  # a contracted piece is an array, one to be contracted anew is bytes
                for j, y in zip(joints[w], p[1:]):
                    x = done[-1]
                    if isinstance(x, bytes):  # its right side was taken already
                        done.append(y)
                    elif len(self.known[j]) == 2 and self.known[j][0] == x[-1] and self.known[j][1] == y[0]:
                        done[-1] = np.concatenate([x, y])
                    else:
                        done[-1:] = [z for z in (x[:-wide], self._bytes(np.concatenate([x[-wide:], y[:wide]])), y[wide:]) if len(z)]
                again[w] = done
            fresh = [x for p in again.values() for x in p if isinstance(x, bytes)]
            self.learn(x for x in dict.fromkeys(fresh) if len(x) <= LONG or x in open_)
            self.learn_long([x for x in dict.fromkeys(fresh) if len(x) > LONG and x not in self.known])
            for w, p in again.items():
                p = [self.known.get(x) if isinstance(x, bytes) else x for x in p]
                open_[w] = p
                if len(p) == 1:
                    self.known[w] = p[0]
            open_ = {w: p for w, p in open_.items() if len(p) > 1}
            wide *= 2

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [[w.encode("utf-8", "replace") for w in self.words(t)] for t in texts]
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        distinct = dict.fromkeys(w for ws in split for w in ws)
        self.learn(w for w in distinct if len(w) <= LONG)
        self.learn_long([w for w in distinct if len(w) > LONG and w not in self.known])
        none = np.empty(0, dtype=np.int32)
        return [np.concatenate([self.known[w] for w in ws]) if ws else none for ws in split]


def encode_corpus(docs: DataFrame, doc_id: Column, text: Column, vocabulary: str | None = None, batch_rows: int = 2000) -> DataFrame:
    """doc_id and ids (array<int>) of every document, without special tokens.

    Null and empty texts have the empty list. The strings of special tokens are ordinary text. Every row of
    the input gives one row, repeated doc_ids too; texts are taken whole.
    """
    path = vocabulary or default_vocabulary()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = None
        for f in frames:
            work = work or Contractor(path)
            for at in range(0, len(f), batch_rows):
                part = f.iloc[at : at + batch_rows]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": work.encode([t if t is not None else "" for t in part["text"]])})

    rows = spread(docs.select(doc_id.alias("doc_id"), text.alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, ids array<int>")


_DECODE = """
SELECT row, string_agg(piece, '' ORDER BY pos) AS hex FROM ids JOIN pieces USING (id) GROUP BY row
"""


def decode_corpus(encoded: DataFrame, vocabulary: str | None = None, batch_rows: int = 2000) -> DataFrame:
    """doc_id and text of (doc_id, ids), by an ordered aggregation of the tokens' bytes. Empty or null ids give ''."""
    path = vocabulary or default_vocabulary()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import duckdb

        db = None
        for f in frames:
            if db is None:
                ids = json.loads(open(path, encoding="utf-8").read())["model"]["vocab"]
                byte_of = {c: b for b, c in enumerate(_characters_of_bytes())}
                pieces = pd.DataFrame([(i, bytes(byte_of[c] for c in t).hex()) for t, i in ids.items() if all(c in byte_of for c in t)], columns=["id", "piece"])
                db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "600MB", "temp_directory": ""})
                db.register("pieces_frame", pieces)
                db.execute("CREATE TABLE pieces AS SELECT * FROM pieces_frame")
            for at in range(0, len(f), batch_rows):
                part = f.iloc[at : at + batch_rows]
                lists = [np.asarray(x if x is not None else [], dtype=np.int64) for x in part["ids"]]
                sizes = [len(x) for x in lists]
                text = [""] * len(lists)
                if sum(sizes):
                    db.register("ids", pd.DataFrame({"row": np.repeat(np.arange(len(lists)), sizes), "pos": np.concatenate([np.arange(n) for n in sizes]), "id": np.concatenate(lists)}))
                    for row, hexed in db.execute(_DECODE).fetchall():
                        text[row] = bytes.fromhex(hexed).decode("utf-8", "replace")
                    db.unregister("ids")
                yield pd.DataFrame({"doc_id": part["doc_id"], "text": text})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, text string")


def count_tokens(docs: DataFrame, text: Column, name: str = "n_tokens", vocabulary: str | None = None) -> DataFrame:
    """docs with the number of tokens of each text in column ``name`` (0 for null and empty texts).

    ``vocabulary`` names a .tiktoken file of ranks; by default that of the 50k byte-level vocabulary.
    """
    import public_tokenizers

    path, cache = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), {}

    @F.pandas_udf("int")
    def counted(texts: pd.Series) -> pd.Series:
        if not cache:
            import base64

            import public_tokenizers as p
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            cache["it"] = tiktoken.Encoding("ranks", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return texts.map(lambda t: len(cache["it"].encode_ordinary(t)) if t else 0).astype("int32")

    return spread(docs).withColumn(name, counted(text))
