"""Harmonic packing of token ids into sequences of at most ``capacity``, independently on every worker.

A class j holds pieces of at most capacity/j ids, and each of its bins takes exactly j pieces. A document is cut into
whole sequences first; what is left goes uncut into its class when a bin of such pieces would be nearly full, and
else its head is cut at the largest capacity/j that fits, which fills a bin without a gap, and the rest is seen to in
the same way. Workers (partitions) close every bin of their own pieces that has its j pieces. The pieces of bins that a
worker can't close (fewer than j a class) meet by class and by group of WORKERS workers and fill bins there. The bins
still open then, at most one a class and group, are laid end to end and cut at every full sequence, so that a group of
workers leaves one open sequence.

Defined results: a null or empty text is its end id alone; pieces of a document have no order among the sequences, but
``start`` says where each belongs; rows that share a doc_id, or have none, are documents of their own; ties and repeated rows
don't matter; very long texts are cut into as many pieces as needed; other columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import bounded_batches, materialise

CAPACITY = 2048
#: Share of a bin that may be padding where a piece is left uncut.
SLACK = 0.02
#: Workers whose left-over pieces are packed together.
WORKERS = 256
#: Chunks of text whose ids a worker remembers, the first ones that it meets.
REMEMBERED = 600_000

_ODD_WHITE = re.compile("[\x1c-\x1f\x85]")
#: Chunks of these characters are normalised by lower() alone and split as the tokenizer's own pattern does; the rest are left to it.
_PLAIN = re.compile("[!-~\u00a1\u00ab\u00bb\u00bf\u00c0-\u012f\u0131-\u0148\u014a-\u017e\u2013\u2014\u2018-\u201d\u2026]*")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
# The steps of the tokenizers whose plain chunks go to the model directly, to the last parameter.
_KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "post_processor": None,
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
}
_tokenizers: dict[str, Tokens] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Tokens(dict):
    """Ids (little-endian unsigned 32-bit) of a text between white space, encoded once.

    Only for tokenizers whose steps are the known ones to the last parameter (NFC, lower case, a pattern, bytes as letters):
    their splitter never joins characters across white space and their normaliser works on each character run, so the ids of
    a text are those of its chunks one after another, and a new chunk of plain characters goes to the model piece by piece,
    which spares the steps. Other chunks go through the whole tokenizer, and so do other tokenizers' whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        made = json.loads(self.encoder.to_str())
        model = {k: v for k, v in made["model"].items() if k in _KNOWN["model"]}
        steps = {"normalizer": made["normalizer"], "pre_tokenizer": made["pre_tokenizer"], "post_processor": made["post_processor"], "model": model}
        self.known = steps == _KNOWN and all(t["special"] for t in made["added_tokens"])
        self.letters = _byte_letters()

    def ids(self, text: str) -> bytes:
        found = self.encoder.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        found = [t.id for t in self.encoder.model.tokenize(letters)]
        return struct.pack(f"<{len(found)}I", *found)

    def __missing__(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            out = self.ids(chunk)
        elif (low := chunk.lower()) != chunk:
            out = self[low]
        else:
            pieces = _PIECES.findall(chunk)
            out = self.piece(chunk) if len(pieces) == 1 else b"".join([self[p] if p.isalpha() else self.piece(p) for p in pieces])
        if len(self) < REMEMBERED and len(chunk) <= 64:
            self[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        # these few characters are white space to Python's split and not to the tokenizer's
        if not self.known or _ODD_WHITE.search(text):
            return self.ids(text)
        return b"".join(map(self.__getitem__, text.split()))


def tokens(path: str) -> Tokens:
    """The tokenizer of a file, once for each worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokens(path)
    return _tokenizers[path]


def cuts(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document of ``length`` ids."""
    out, at = [], 0
    while length - at >= capacity:
        out.append((at, capacity, 1))
        at += capacity
    while (rest := length - at) > 0:
        j = capacity // rest
        if capacity - j * rest <= slack * capacity:
            out.append((at, rest, j))
            break
        head = capacity // (j + 1)
        out.append((at, head, j + 1))
        at += head
    return out


_PIECE = "doc_id {kind}, start long, length long, doc_tokens long, ids binary, class int, sequence_id long, offset long, worker int"


def _pack(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int, slack: float) -> Iterator[pa.RecordBatch]:
    """Cut, and close the bins that have all their pieces; those of open bins come last, without a sequence."""
    from pyspark import TaskContext

    worker = TaskContext.get().partitionId()
    known, last, made = tokens(path), struct.pack("<I", end), 0
    bins: dict[int, list] = defaultdict(list)
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "class", "sequence_id", "offset", "worker"]
    kind = None

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        kind, done = batch.column(0).type, []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = known.encode(text or "") + last
            n = len(ids) // 4
            for start, length, j in cuts(n, capacity, slack):
                held = bins[j]
                held.append((doc, start, length, n, ids[4 * start : 4 * (start + length)], j))
                if len(held) == j:
                    at = 0
                    for piece in held:
                        done.append((*piece, (worker << 33) | made, at, worker))
                        at += piece[2]
                    made += 1
                    held.clear()
        if done:
            yield batch_of(done)
    if rest := [(*piece, None, None, worker) for held in bins.values() for piece in held]:
        yield batch_of(rest)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset."""
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = partial(_pack, path=tokenizer, end=end, capacity=capacity, slack=slack)
    pieces = materialise(spark, docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, _PIECE.format(kind=kind)), "pieces", "zstd")
    columns = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    closed = pieces.where(F.col("sequence_id").isNotNull()).select(*columns)
    # bins that no worker could close: fewer than j pieces from each worker, met by class and group of workers
    left = pieces.where(F.col("sequence_id").isNull()).withColumn("party", (F.col("worker") / WORKERS).cast("int"))
    numbered = left.selectExpr("*", "row_number() over (partition by class, party order by length desc, worker, doc_id, start, doc_tokens) - 1 as nth").selectExpr("*", "cast(floor(nth / class) as long) as bin")
    binned = materialise(
        spark,
        numbered.selectExpr(
            "doc_id", "start", "length", "doc_tokens", "ids", "class", "party", "bin", "nth",
            "count(*) over (partition by class, party, bin) = class as whole",
            "coalesce(sum(length) over (partition by class, party, bin order by nth rows between unbounded preceding and 1 preceding), 0) as offset",
        ),
        "met", "zstd",
    )
    # sequences that workers share count down from -1, apart from the workers' own
    met = binned.where("whole").selectExpr("doc_id", "start", "length", "doc_tokens", "ids", f"-1 - (1 + bin + {1 << 18}L * (class + {capacity + 1}L * party)) as sequence_id", "offset")
    # at most one open bin a class and group of workers: these few pieces follow one another and are cut where a sequence is full
    line = binned.where("not whole").selectExpr("*", "coalesce(sum(length) over (partition by party order by class, nth rows between unbounded preceding and 1 preceding), 0) as at")
    parts = line.selectExpr("*", f"{capacity} - at % {capacity} as room", f"cast(floor(at / {capacity}) as long) as row").selectExpr(
        "*", "explode(if(length > room, array(struct(0L as skip, room as n, row as seq, at % {0} as off), struct(room as skip, length - room as n, row + 1 as seq, 0L as off)), array(struct(0L as skip, length as n, row as seq, at % {0} as off)))) as cut".format(capacity)
    )
    joined = parts.selectExpr(
        "doc_id", "start + cut.skip as start", "cut.n as length", "doc_tokens", "substring(ids, cast(4 * cut.skip + 1 as int), cast(4 * cut.n as int)) as ids",
        f"-1 - ({1 << 18}L * {capacity + 1}L * party + cut.seq * {capacity + 1}L * {1 << 18}L * {1 << 16}L) as sequence_id", "cut.off as offset",
    )
    return closed.unionByName(met.select(*columns)).unionByName(joined.select(*columns))
