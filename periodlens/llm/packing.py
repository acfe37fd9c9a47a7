"""Lexical retrieval packing: windows of fixed length filled with BM25 neighbours of a seed.

A document is its token ids and an end id.  Whole windows are cut off the front of longer documents;
what is left is packed.  The corpus is dealt into index shards of at most ``SHARD_TOKENS`` tokens: documents are
routed by the least of their rarer tokens under a fixed permutation (documents that share rare tokens tend to
meet); routes whose counted tokens exceed a shard, and only these, are dealt over as many tasks as they would
fill shards; rows are sorted by that token within a task; a shard ends where its tokens are full.  Each shard has a BM25 inverted
index.  The first unused document seeds a window; the index returns its unused neighbours by the seed's
``QUERY_TERMS`` heaviest terms, best first, and they fill the window greedily.  A neighbour that does not fit
is cut where the window ends, and its rest seeds the next one.  Without a neighbour the next unused
document of the shard is taken.  So a task pads one window only, its last.

The tokenizer encodes each frequent word once: words are counted first, and the most frequent ones, at most
``DICTIONARY``, are encoded and broadcast with their ids; rarer ones are encoded where they occur.

A task holds one shard at a time and documents travel once.  A repeated task gives the same
windows: its rows are sorted, and window ids are made of the partition and a counter.

Defined results: a null or empty text is its end id alone; an empty table gives an empty one; rows with
equal ids are separate documents; a null id is kept as null; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from periodlens.llm.common import stored

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 2_000_000
QUERY_TERMS = 16
K1, B = 1.2, 0.75
COMMON_IDS = 1000             # ids below are bytes and frequent merges: they route only where there is no other
DICTIONARY = 400_000          # frequent words that are encoded once for all tasks
CACHE_WORDS = 900_000         # words that a worker remembers, those included
HELD_WORDS = 500_000          # words that a task counts before it sends them


# A word with an ASCII letter before its last characters, all of them ASCII punctuation but the apostrophe.
_PUNCTUATED = re.compile(rb"(.*[a-z])([!-&(-/:-@\[-`{-~]+)", re.S)
_ENDS = frozenset(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")


def words_of(text: bytes | None) -> list[bytes]:
    """The words whose ids in turn are the text's ids."""
    # the tokenizer looks for its special tokens before it lower-cases
    return (text.lower() if b"<|" not in text else text).split() if text else []


def _byte_letters() -> dict:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters for themselves, the
    others in order from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return dict(zip([*own, *sorted(set(range(256)) - set(own))], map(chr, [*own, *range(256, 512)])))


class Encoder(dict):
    """Token ids of words as little-endian 16-bit integers; a word it has not seen is encoded when it is asked for.

    The tokenizer lower-cases, drops white space and never joins across it, so a text's ids are those of
    its words in turn.  A word of lower-case letters only is one piece that nothing changes, so its bytes go to the merges
    directly; whether that holds for this tokenizer is tried first.  ``base`` are words that it always holds.
    """

    TRIED = ("a", "the", "straße", "ñandú", "слово", "été", "zzyzx", "λόγος")

    def __init__(self, path: str, base: dict | None = None):
        super().__init__(base or {})
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.base, self.letters = Tokenizer.from_file(path), base or {}, _byte_letters()
        self.merges = self.tokenizer.model
        try:
            self.direct = all(self._merged(w) == self._whole(w) for w in self.TRIED)
        except Exception:                          # another kind of model
            self.direct = False

    def _whole(self, word: str) -> bytes:
        return array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _merged(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.merges.tokenize(spelled)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        # punctuation after a letter is split off by the tokenizer, so both parts can be encoded alone
        if word[-1] in _ENDS and b"<|" not in word and (m := _PUNCTUATED.fullmatch(word)):
            ids = self[m[1]] + self[m[2]]
        else:
            w = word.decode()
            # Latin, Greek and Cyrillic: letters are letters in every version of Unicode
            plain = self.direct and w.isalpha() and max(w) < "\u0530" and w == w.lower() and is_normalized("NFC", w)
            ids = self._merged(w) if plain else self._whole(w)
        self[word] = ids
        return ids

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.update(self.base)
        return [b"".join(map(self.__getitem__, words_of(t))) for t in texts]


_ENCODERS: dict = {}


def encoder(path: str, shared=None) -> Encoder:
    """One for each worker process and dictionary; ``shared`` is a broadcast of ``(key, words, ids)``."""
    key = (path, shared.value[0] if shared else None)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, dict(zip(*(x.to_pylist() for x in shared.value[1:]))) if shared else None)
    return _ENCODERS[key]


def frequent_words(docs: DataFrame, text_col: str, path: str, most: int = DICTIONARY) -> DataFrame:
    """(word, ids) of at most ``most`` words, the most frequent ones, each encoded once.

    Words are counted in every text (those that a task sees once are not sent); only the number of words of each count
    comes to the driver.  The choice decides where a word is encoded, never its ids.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def send():
            words = [w for w, n in held.items() if n > 1]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([held[w] for w in words], pa.int64())], names=["word", "n"])
            held.clear()
            return out
        for b in batches:
            for at in range(0, b.num_rows, 500):
                for t in b.column(0).slice(at, 500).cast(pa.binary()).to_pylist():
                    held.update(words_of(t))
                if len(held) > HELD_WORDS:
                    yield send()
        yield send()

    counts = stored(docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
                    "word-counts")
    # the least count of which there are not too many words from there on: a row for each count below 1,000
    sizes = counts.groupBy(F.least("n", F.lit(1000)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, total = None, 0
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["n"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            words = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc[w] for w in words], pa.binary())], names=["word", "ids"])

    chosen = counts.where(F.col("n") >= least) if least is not None else counts.limit(0)
    return stored(chosen.select("word").mapInArrow(encode, "word binary, ids binary"), "dictionary")


def _routes() -> np.ndarray:
    """Rank of each token id under a fixed permutation; frequent ids come last."""
    rank = np.random.default_rng(7).permutation(1 << 16).astype(np.uint32)
    rank[:COMMON_IDS] += np.uint32(1 << 16)
    return rank


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(doc, route, ids): ids are little-endian 16-bit integers, the end id last."""
    words = frequent_words(docs, text_col, path).toArrow()           # at most DICTIONARY rows
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, *(words.column(c).combine_chunks() for c in ("word", "ids"))))
    schema = f"doc {docs.schema[id_col].dataType.simpleString()}, route int, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, end = _routes(), np.asarray([END_ID], "<u2").tobytes()
        enc = encoder(path, shared)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = [x + end for x in enc.texts(part.column(1).cast(pa.binary()).to_pylist())]
                route = [int(rank[np.frombuffer(x, "<u2")].min()) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(route, pa.int32()), pa.array(ids, pa.binary())],
                                                 names=["doc", "route", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


class Shard:
    """A BM25 index over some documents, and which of them are unused."""

    def __init__(self, docs: list[np.ndarray]):
        self.size = len(docs)
        # every id but the end, which all have; frequent ones weigh little by their idf
        terms, counts = zip(*(np.unique(d[d != END_ID], return_counts=True) for d in docs))
        sizes = np.fromiter(map(len, docs), np.float64, self.size)
        each = np.fromiter(map(len, terms), np.int64, self.size)
        doc = np.repeat(np.arange(self.size), each)
        term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.float64)
        df = np.bincount(term, minlength=1 << 16)
        idf = np.log1p((self.size - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        ends = np.cumsum(each)
        self.query = []
        for lo, hi in zip(ends - each, ends):
            w = weight[lo:hi]
            top = np.argpartition(-w, QUERY_TERMS - 1)[:QUERY_TERMS] if hi - lo > QUERY_TERMS else slice(None)
            self.query.append(term[lo:hi][top])
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.start = np.concatenate(([0], np.cumsum(df)))
        self.unused = np.ones(self.size, bool)
        self.next = 0

    def first_unused(self) -> int | None:
        while self.next < self.size and not self.unused[self.next]:
            self.next += 1
        return self.next if self.next < self.size else None

    def neighbours(self, doc: int) -> Iterator[int]:
        """Unused documents by falling BM25 score for the document's heaviest terms."""
        spans = [slice(self.start[t], self.start[t + 1]) for t in self.query[doc]]
        if not spans:
            return
        score = np.bincount(np.concatenate([self.doc[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), self.size)
        score[~self.unused] = 0
        while True:
            best = int(score.argmax())
            if score[best] <= 0:
                return
            score[best] = 0
            yield best


def _pack_rows(rows: Iterator[tuple], window: int, partition: int) -> Iterator[tuple]:
    """(doc, start, length, doc_tokens, sequence_id, offset, ids) of every piece of a task's sorted rows."""
    base, number = partition << 36, 0
    room, seq = 0, -1                                   # of the open window

    def opened():
        nonlocal room, seq, number
        if not room:
            room, seq, number = window, base + number, number + 1

    def emptied(shard_docs):
        nonlocal room
        tails = [len(ids) // window * window for _, ids in shard_docs]
        shard = Shard([ids for _, ids in shard_docs])
        for k, (doc, ids) in enumerate(shard_docs):     # whole windows stand alone
            yield from whole(doc, ids, tails[k])
            if tails[k] == len(ids):
                shard.unused[k] = False
        ahead: Iterator[int] = iter(())
        while (pick := next((d for d in ahead if shard.unused[d]), None)) is not None or \
                (pick := shard.first_unused()) is not None:
            shard.unused[pick] = False
            doc, ids = shard_docs[pick]
            at, seeds = tails[pick], room == 0
            while at < len(ids):
                seeds = seeds or room == 0
                opened()
                n = min(room, len(ids) - at)
                yield doc, at, n, len(ids), seq, window - room, ids[at:at + n]
                at, room = at + n, room - n
            if seeds and room:                          # the open window begins with this document
                ahead = shard.neighbours(pick)

    def whole(doc, ids, upto):
        nonlocal number
        for at in range(0, upto, window):
            yield doc, at, window, len(ids), base + number, 0, ids[at:at + window]
            number += 1

    held, tokens = [], 0
    for doc, raw in rows:
        ids = np.frombuffer(raw, "<u2")
        held.append((doc, ids))
        tokens += len(ids)
        if tokens >= SHARD_TOKENS:
            yield from emptied(held)
            held, tokens = [], 0
    if held:
        yield from emptied(held)


def salted(rows: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``rows`` with a salt: 0 but for routes of more tokens than a shard has."""
    tokens = F.sum(F.length("ids") / 2)
    hot = (rows.groupBy("route").agg(F.ceil(tokens / shard_tokens).alias("salts")).where("salts > 1"))
    spread = F.pmod(F.xxhash64("doc", "ids"), F.col("salts"))
    return rows.join(F.broadcast(hot), "route", "left").withColumn("salt", F.coalesce(spread, F.lit(0))).drop("salts")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """The pieces of all documents with their place in a window.

    Returns id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit
    token ids) of every piece.
    """
    rows = stored(tokenized(docs, id_col, text_col, tokenizer_path), "tokens")
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, start long, length long, doc_tokens long, "
              "sequence_id long, offset long, ids binary")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (salted(rows).repartition(parts, "route", "salt").sortWithinPartitions("route", "doc", "ids").select("doc", "ids"))
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = ((d, x) for b in batches for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        out, size = [], 0

        def batch():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:6]],
                 pa.array([x.astype("<u4").tobytes() for x in cols[6]], pa.binary())],
                names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for piece in _pack_rows(source, window, TaskContext.get().partitionId()):
            out.append(piece)
            size += piece[2]
            if size >= 1_000_000:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    return dealt.mapInArrow(run, schema)
