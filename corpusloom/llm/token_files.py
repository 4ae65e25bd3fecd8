"""Token ids of documents in Arrow files of equal-length sequences.

Documents are written in ascending id order, each with an end id, one shard for each range
of ids. A shard is an Arrow IPC file whose columns are fixed-size lists: ``ids`` (16 bits
where the vocabulary allows it, else 32) and ``mask`` (bytes: 0 on the padding of the last
sequence, else 1; a dictionary of the full mask and that of the last sequence, so that masks are views too but take a
byte for each sequence). All record batches but the last have equally many sequences, so sequence ``k``
is row ``k % ROWS`` of batch ``k // ROWS``: a reader maps the file and gets a view without
copying. A second Arrow file lists the shard's documents. Both are written under
temporary names; the manifest, a table written last, names the shards that count.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .shared_files import committed, located
from .tables import python_tasks, saved, whole_text

LENGTH = 2048
ROWS = 256
END_ID = 2
CACHED_WORDS = 100_000
PIECE = 1 << 21

# Letters of Latin-1 lower-case and normalise one by one.
_PLAIN = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+\z"
_WORD_SPLIT = "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class WordCache:
    """Encodes whole texts with a tokenizer file, each distinct word once.

    Works word by word only if the file's own rules never look across white space:
    text is then cut at spaces and line feeds, and between a letter and a stop or comma, and every
    distinct piece is encoded once and kept, up to a bounded number. Other tokenizers, and texts with the marks of special tokens,
    are encoded whole. The ids are those of encoding each whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            rules = json.load(source)
        splits = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        pattern = (splits[0].get("pattern") or {}).get("Regex", "")
        model = rules["model"]
        self.by_word = pattern.endswith(_WORD_SPLIT) and model.get("end_of_word_suffix") == "</w>"
        self.special = [t["content"] for t in rules.get("added_tokens") or []]
        if self.by_word:
            size = max(model["vocab"].values()) + 1
            self.ends_word = np.zeros(size, dtype=bool)
            self.ends_word[[i for token, i in model["vocab"].items() if token.endswith("</w>")]] = True
            level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
            split = {"type": "WhitespaceSplit"}
            bare = rules | {"normalizer": None, "added_tokens": [], "pre_tokenizer": split}
            self.ascii = Tokenizer.from_str(json.dumps(bare))
            bare["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [split, level]}
            self.latin = Tokenizer.from_str(json.dumps(bare))
        self.known = self.older = pa.array([], pa.large_string())
        self.ids = self.older_ids = pa.array([], pa.large_list(pa.uint32()))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.full.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _look_up(self, words: pa.Array) -> pa.Array:
        """Places of words in ``ids``; what was used lately is kept longest."""
        if len(self.known) > CACHED_WORDS:
            self.older, self.older_ids = self.known, self.ids
            self.known, self.ids = self.known[:0], self.ids[:0]
        at = pc.index_in(words, value_set=self.known)
        unseen = words.filter(pc.is_null(at)).unique()
        if len(unseen):
            back = pc.index_in(unseen, value_set=self.older)
            learned, ids = self._learn(unseen.filter(pc.is_null(back)))
            added = pa.concat_arrays([unseen.filter(pc.is_valid(back)), learned])
            place = pc.add(pc.index_in(words, value_set=added), pa.scalar(len(self.known), pa.int32()))
            at = pc.coalesce(at, place)
            self.known = pa.concat_arrays([self.known, added])
            self.ids = pa.concat_arrays([self.ids, self.older_ids.take(back.drop_null()), ids])
        return at

    def _learn(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Unseen words with their ids: plain ones many to a call, cut where a token ends a word."""
        in_ascii, plain = pc.ascii_is_alpha(words), pc.match_substring_regex(words, _PLAIN)
        found, sizes = [], []
        groups = [words.filter(in_ascii), words.filter(pc.and_not(plain, in_ascii)), words.filter(pc.invert(plain))]
        for encoder, some in zip((self.ascii, self.latin), groups):
            for low in range(0, len(some), 1000):
                part = some.slice(low, 1000).to_pylist()
                ids = np.array(encoder.encode(" ".join(part).lower(), add_special_tokens=False).ids, dtype=np.uint32)
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                if len(ends) != len(part):
                    raise ValueError("a word has no end mark")
                found.append(ids)
                sizes.append(np.diff(ends, prepend=0))
        other = self._whole(groups[2].to_pylist())
        sizes.append(np.fromiter(map(len, other), np.int64, len(other)))
        values = pa.array(np.concatenate([np.zeros(0, dtype=np.uint32), *found, *other]))
        return pa.concat_arrays(groups), pa.LargeListArray.from_arrays(np.cumsum(np.r_[0, *sizes]), values)

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are cut into words, and how many ids each has.

        Only words of ASCII letters are lowered here: others can hold marks of special tokens, or letters that
        compose with a combining mark in one case only.
        """
        even = pc.replace_substring(texts, "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(even, "([A-Za-z])([.,])", "\\1 \\2"), " ")
        coded = words.flatten().dictionary_encode()
        said = coded.dictionary
        at = self._look_up(pc.if_else(pc.ascii_is_alpha(said), pc.ascii_lower(said), said))
        held = self.ids.take(at.take(coded.indices))
        cuts = held.offsets.to_numpy()[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return held.flatten().to_numpy(), np.diff(cuts)

    def _marked(self, text: str) -> bool:
        """Whether the text holds the mark of a special token, in any case."""
        low = text.lower()
        return any(s in text or s.lower() in low for s in self.special)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text in order."""
        held: list[str] = []
        room = 0
        for text in texts:
            apart = not self.by_word or self._marked(text)
            if held and (apart or room + len(text) > PIECE):
                yield from self._cut(held)
                held, room = [], 0
            if apart:
                yield self._whole([text])[0]
            elif len(text) > PIECE:
                yield np.concatenate([ids for piece in _pieces(text) for ids in self._cut([piece])])
            else:
                held.append(text)
                room += len(text)
        if held:
            yield from self._cut(held)

    def _cut(self, texts: list[str]) -> list[np.ndarray]:
        ids, many = self._some(pa.array(texts, pa.large_string()))
        return np.split(ids, np.cumsum(many)[:-1])


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts that end at a space; a part without one stays whole."""
    low = 0
    while low < len(text):
        cut = text.find(" ", low + PIECE)
        high = len(text) if cut < 0 else cut
        yield text[low:high]
        low = high


@lru_cache(maxsize=2)
def _cache(path: str) -> WordCache:
    return WordCache(path)


def _sequences(ids: np.ndarray, length: int, kind: pa.DataType) -> pa.RecordBatch:
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, dtype=kind.to_pandas_dtype())
    padded[: len(ids)] = ids
    last = len(ids) - (rows - 1) * length
    masks, which = [np.ones(length, dtype=np.uint8)], np.zeros(rows, dtype=np.int8)
    if last < length:
        masks.append((np.arange(length) < last).astype(np.uint8))
        which[-1] = 1
    kinds = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(masks)), length)
    return pa.record_batch(
        {
            "ids": pa.FixedSizeListArray.from_arrays(pa.array(padded), length),
            "mask": pa.DictionaryArray.from_arrays(pa.array(which), kinds),
        }
    )


def _mask(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The mask of a row, a view of the file."""
    held = batch["mask"]
    return held.dictionary.slice(held.indices[row].as_py(), 1).flatten().to_numpy(zero_copy_only=True).view(bool)


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    length: int = LENGTH,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Writes shards under ``folder``; returns the manifest ``(shard, file, n_docs, n_ids)``.

    Documents come in ascending id order, or by the columns ``order`` first.
    Null and empty texts are documents of the end id alone. Rows with equal ids are ordered
    by their text; a null id comes first. An empty table gives an empty manifest; other columns
    are not written. ``tokenizer`` is a tokenizer file that every worker can read.
    """
    python_tasks(docs.sparkSession, 1500)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder, path = _cache(tokenizer), f"{folder}/shard-{shard:06d}.arrow"
        kind = pa.uint16() if encoder.full.get_vocab_size() <= 1 << 16 else pa.uint32()
        seen_ids, sizes, done = [], [], 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        schema = _sequences(np.zeros(1, dtype="<u4"), length, kind).schema
        deltas = pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True)  # the last mask is known last
        with committed(path) as sink, pa.ipc.new_file(sink, schema, options=deltas) as out:
            held, room = [], 0

            def flush(last: bool):
                nonlocal held, room
                ids = np.concatenate(held) if held else np.zeros(0, dtype="<u4")
                whole = len(ids) if last else len(ids) // (ROWS * length) * ROWS * length
                for low in range(0, whole, ROWS * length):
                    out.write_batch(_sequences(ids[low : min(whole, low + ROWS * length)], length, kind))
                held, room = [ids[whole:]], len(ids) - whole

            for batch in _with(first, batches):
                seen_ids.append(batch["doc_id"])
                for ids in encoder.encode(batch["text"].to_pylist()):
                    held += [ids, np.array([end_id], dtype="<u4")]
                    sizes.append(len(ids) + 1)
                    room += len(ids) + 1
                    if room >= ROWS * length:
                        flush(False)
                pa.default_memory_pool().release_unused()
            done = sum(sizes)
            flush(True)
        size = np.array(sizes, dtype=np.int64)
        listed = pa.table([pa.chunked_array(seen_ids), np.cumsum(size) - size, size], schema=_DOCS)
        with committed(f"{path}.docs") as sink, pa.ipc.new_file(sink, _DOCS) as out:
            out.write_table(listed, max_chunksize=10_000)
        yield pa.record_batch({"shard": [shard], "file": [path], "n_docs": [len(size)], "n_ids": [done]})

    by = [f"_by_{n}" for n in range(len(order))] + ["doc_id"]
    ordered = (
        docs.select(
            *[F.col(column).alias(name) for name, column in zip(by, order)],
            F.col(doc_id).cast("bigint").alias("doc_id"),
            whole_text(text).alias("text"),
        )
        .repartitionByRange(*by)
        .sortWithinPartitions(*by, "text")
        .select("doc_id", "text")
    )
    return saved(ordered.mapInArrow(write, "shard bigint, file string, n_docs bigint, n_ids bigint"), "token-manifest")


def _with(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def sequence(path: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``k`` of a shard on a mounted folder, both views of the mapped file."""
    shard = pa.ipc.open_file(pa.memory_map(located(path)[1]))
    batch = shard.get_batch(k // ROWS)
    ids = batch["ids"].slice(k % ROWS, 1).flatten().to_numpy(zero_copy_only=True)
    return ids, _mask(batch, k % ROWS)


def stored_documents(path: str) -> Iterator[tuple[int | None, int, int, int]]:
    """``(doc_id, start in the shard, n_tokens, crc32)`` of a shard's documents, batch by batch."""
    system, place = located(path)
    with system.open_input_file(place) as source, system.open_input_file(f"{place}.docs") as listing:
        shard, docs = pa.ipc.open_file(source), pa.ipc.open_file(listing)
        batches = (shard.get_batch(k) for k in range(shard.num_record_batches))
        data, low = b"", 0
        for k in range(docs.num_record_batches):
            for doc_id, start, size in zip(*(c.to_pylist() for c in docs.get_batch(k).columns)):
                crc, left = 0, 4 * size
                while left:
                    if low == len(data):
                        batch = next(batches)
                        ids, last = batch["ids"].flatten().to_numpy(), _mask(batch, batch.num_rows - 1)
                        data, low = ids[: len(ids) - len(last) + last.sum()].astype("<u4").tobytes(), 0
                    take = min(left, len(data) - low)
                    crc = zlib.crc32(memoryview(data)[low : low + take], crc)
                    low, left = low + take, left - take
                yield doc_id, start, size, crc


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of all documents, read from the shards.

    ``start`` counts the ids of all documents before, over shards. The window that adds
    them up has a row for each shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                held = []
                for doc_id, start, size, crc in stored_documents(path):
                    held.append((doc_id, base + start, size, crc))
                    if len(held) == 10_000:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return placed.repartition(tasks, "file").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def _rows(held: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*held)]
    return pa.record_batch(dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns)))
