"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each partition."""

from __future__ import annotations

import base64
import contextlib
import ctypes
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

#: Ids that one aggregation takes, bytes of text that are split at once, and words that a task remembers.
IDS, BYTES, REMEMBERED = 100_000, 1_000_000, 200_000
#: Rows that one recursive query holds at most (it keeps those of all rounds).
ROWS = 1_200_000
#: Longer words (in bytes) are encoded in windows of this size, each half over the next; see ``Coder._long``.
WINDOW = 128

#: A row holds a token and its right neighbour; a round joins these pairs with the merge table, picks each word's
#: smallest (rank, position), and contracts that pair: the left row goes, the right one and the neighbour change.
_ENCODE = """
WITH RECURSIVE rounds(n, word, pos, id, next) AS (
  SELECT 0, word, pos, id, next FROM pieces
  UNION ALL
  (WITH best AS (SELECT word, min(merged::BIGINT * 65536 + pos) AS k FROM rounds JOIN merges ON id = a AND next = b GROUP BY word)
   SELECT n + 1, r.word,
          CASE WHEN pos > k % 65536 THEN pos - 1 ELSE pos END,
          CASE WHEN pos = k % 65536 + 1 THEN (k // 65536)::INT ELSE id END,
          CASE WHEN pos = k % 65536 - 1 THEN (k // 65536)::INT ELSE next END
   FROM rounds r JOIN best USING (word) WHERE pos <> k % 65536)
), final AS (SELECT word, max(n) AS n FROM rounds GROUP BY word)
SELECT word, id FROM rounds JOIN final USING (word, n) ORDER BY word, pos
"""

#: The same for pieces with long repeats: where no token that holds the contracted one ranks before it (``safe``), a round
#: contracts every pair of the smallest rank, from the left and without overlap, as one by one would; else the leftmost.
_ENCODE_REPEATS = """
WITH RECURSIVE rounds(n, word, pos, id, next) AS (
  SELECT 0, word, pos, id, next FROM pieces
  UNION ALL
  (WITH hit AS (SELECT word, pos, merged, safe FROM rounds JOIN merges ON id = a AND next = b WHERE n < $most),
   best AS (SELECT word, min(merged) AS m FROM hit GROUP BY word),
   equal AS (SELECT h.word, h.pos, m, safe, row_number() OVER (PARTITION BY h.word ORDER BY h.pos) AS nth FROM hit h JOIN best ON h.word = best.word AND merged = m),
   chained AS (SELECT *, row_number() OVER (PARTITION BY word, pos - nth ORDER BY pos) AS place FROM equal),
   picked AS (SELECT word, pos, m FROM chained WHERE nth = 1 OR safe AND place % 2 = 1),
   marked AS (SELECT r.n, r.word, r.pos, r.id, r.next, p.m, lag(p.m) OVER w AS before, lead(p.m) OVER w AS after, count(p.m) OVER (w ROWS UNBOUNDED PRECEDING) AS gone
              FROM rounds r JOIN best ON r.word = best.word LEFT JOIN picked p ON r.word = p.word AND r.pos = p.pos WINDOW w AS (PARTITION BY r.word ORDER BY r.pos))
   SELECT n + 1, word, (pos - gone)::INT, coalesce(before, id), coalesce(after, next) FROM marked WHERE m IS NULL)
), final AS (SELECT word, max(n) AS n FROM rounds GROUP BY word)
SELECT word, pos, id, next, n FROM rounds JOIN final USING (word, n) ORDER BY word, pos
"""

#: Pieces are aggregated in the order of their positions.
_DECODE = "SELECT part, string_agg(piece, '' ORDER BY pos) AS text FROM ids JOIN vocabulary USING (id) GROUP BY part"


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read once on the driver and shipped with the tasks (under 1 MB for 50,000 ranks)."""
    with open(path, "rb") as f:
        return f.read()


def latin_pattern(pattern: str) -> re.Pattern | None:
    r"""The same pattern for texts of code points below 256, with \\p{L}, \\p{N}, \\s and \\S spelt out; None for other escapes.

    Python's own matcher is more than twice as fast as the one that knows Unicode properties.
    """
    def spelt(name: str) -> str:
        return "".join(f"\\x{i:02x}" for i in range(256) if regex.fullmatch(name, chr(i)))

    inside, out, at = False, [], 0
    known = {n: spelt(n) for n in (r"\p{L}", r"\p{N}", r"\s")}
    while at < len(pattern):
        name = next((n for n in known if pattern.startswith(n, at)), None)
        if name:
            out.append(known[name] if inside else f"[{known[name]}]")
            at += len(name)
        elif pattern.startswith(r"\S", at) and not inside:
            out.append(f"[^{known[r'\s']}]")
            at += 2
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return re.compile("".join(out))


@lru_cache(maxsize=2)
def _vocabulary(ranks: bytes) -> tuple[dict[bytes, int], pa.Table, pa.Table]:
    """(ranks by token, merge table, pieces as one character per byte): some MB, kept by the process for later tasks."""
    by_token = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, ranks.split(b"\n")))}
    merges = [(a, b, rank) for token, rank in by_token.items() for i in range(1, len(token)) if (a := by_token.get(token[:i])) is not None and (b := by_token.get(token[i:])) is not None]
    early = {part for a, b, rank in merges for part in (a, b) if rank < part}
    table = pa.table({n: pa.array([m[i] for m in merges], pa.int32()) for i, n in enumerate(("a", "b", "merged"))})
    table = table.append_column("safe", pa.array([m[2] not in early for m in merges]))
    return by_token, table, pa.table({"id": pa.array(by_token.values(), pa.int32()), "piece": [t.decode("latin-1") for t in by_token]})


class Coder:
    """Encodes texts to packed ids (little-endian uint32) and decodes them; all tables live in an in-memory DuckDB."""

    def __init__(self, ranks: bytes, pattern: str):
        import duckdb

        by_token, merges, pieces = _vocabulary(ranks)
        self.pattern, self.latin = regex.compile(pattern), latin_pattern(pattern)
        self.bytes = np.array([by_token[bytes([b])] for b in range(256)], np.int32)
        self.length = np.zeros(max(by_token.values()) + 1, np.int64)
        self.length[list(by_token.values())] = list(map(len, by_token))
        self.known: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        for name, table in (("merges", merges), ("vocabulary", pieces)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def close(self) -> None:
        """Gives the tables' and words' memory back: Spark keeps the process for later tasks of other operators."""
        self.db.close()
        self.known = {}
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Packed ids of each text; null texts count as empty."""
        split = [self._words(t) if t else [] for t in texts]
        words = set().union(*split)
        fresh = list(words.difference(self.known))
        self.known.update(zip(fresh, (ids.tobytes() for ids in self._merged([w.encode("utf-8", "surrogatepass") for w in fresh])), strict=True))
        packed = [b"".join(map(self.known.__getitem__, each)) for each in split]
        if len(self.known) > REMEMBERED:  # the words of the last texts go on, the others are forgotten
            self.known = {w: self.known[w] for w in words}
        return packed

    def _words(self, text: str) -> list[str]:
        if self.latin is not None:
            with contextlib.suppress(UnicodeEncodeError):
                text.encode("latin-1")
                return self.latin.findall(text)
        return self.pattern.findall(text)

    def _merged(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of every word: short ones as they are, long ones by windows, all of them by recursive queries."""
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(words)
        group: list[int] = []
        rows = 0
        for i, word in enumerate(words):
            if len(word) > WINDOW:
                out[i] = self._long(word)
                continue
            if group and rows + len(word) ** 2 > ROWS:
                self._settle(group, words, out)
                group, rows = [], 0
            group.append(i)
            rows += len(word) ** 2
        if group:
            self._settle(group, words, out)
        return out

    def _settle(self, group: list[int], words: list[bytes], out: list[np.ndarray]) -> None:
        for i, ids in zip(group, self._query([words[i] for i in group]), strict=True):
            out[i] = ids

    def _query(self, pieces: list[bytes], repeats: bool = False) -> list[np.ndarray]:
        """The ids of each piece by one recursive query, or by several of bounded rounds for pieces with repeats."""
        size = np.array([len(p) for p in pieces])
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        end = np.cumsum(size)
        following = np.append(ids[1:], np.int32(-1))
        following[end - 1] = -1
        pos = np.arange(len(ids)) - np.repeat(end - size, size)
        state = pa.table({"word": np.repeat(np.arange(len(pieces), dtype=np.int32), size), "pos": pos.astype(np.int32), "id": ids, "next": following})
        while True:
            self.db.register("pieces", state)
            if repeats:
                most = max(2, ROWS // len(state))
                state = self.db.execute(_ENCODE_REPEATS, {"most": most}).to_arrow_table()
            else:
                most, state = None, self.db.sql(_ENCODE).to_arrow_table()
            self.db.unregister("pieces")
            if most is None or max(state.column("n").to_pylist()) < most:
                break
        at, ids = state.column("word").to_numpy(), state.column("id").to_numpy().astype("<u4")
        return np.split(ids, np.searchsorted(at, np.arange(1, len(pieces))))

    def _united(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        while at < len(pieces):
            upto, held = at, 0
            while upto < len(pieces) and (upto == at or held + len(pieces[upto]) <= ROWS // 16):
                held += len(pieces[upto])
                upto += 1
            out += self._query(pieces[at:upto], repeats=True)
            at = upto
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """The ids of a long word from those of windows, each half over the next.

        A run of tokens is a word's encoding if and only if every two neighbours, taken alone, encode to themselves: merges
        inside them happen in the same order in the word, so the first that crossed their border would cross it there,
        too. Neighbours in a window's encoding do; so two windows with a token in common (the same bytes of the word) are
        joined at it. Windows that share none, as in runs of one character, are united and encoded again.
        """
        half = WINDOW // 2
        spans = [(at, min(at + WINDOW, len(word))) for at in range(0, len(word) - half, half)]
        found = self._merged([word[a:b] for a, b in spans])
        while True:
            starts = [a + np.cumsum(self.length[ids]) - self.length[ids] for (a, _), ids in zip(spans, found, strict=True)]
            # a token of the word is known by its begin and id
            keys = [at << 32 | ids.astype(np.int64) for at, ids in zip(starts, found, strict=True)]
            shared = [np.intersect1d(one, two, assume_unique=True)[:1] for one, two in zip(keys, keys[1:], strict=False)]
            apart = [i for i, s in enumerate(shared) if not len(s)]
            if not apart:
                break
            united: dict[int, tuple[int, int]] = {}
            for i in apart:  # every other one of a row of windows without a common token
                if i - 1 not in united:
                    united[i] = spans[i][0], spans[i + 1][1]
            new = dict(zip(united, self._united([word[a:b] for a, b in united.values()]), strict=True))
            keep = [i for i in range(len(spans)) if i - 1 not in united]
            found = [new.get(i, found[i]) for i in keep]
            spans = [united.get(i, spans[i]) for i in keep]
        ids, begin = [], -1
        for i, key in enumerate(keys):
            stop = shared[i][0] if i < len(shared) else np.iinfo(np.int64).max
            ids.append(found[i][(key >= begin) & (key < stop)])
            begin = stop
        return np.concatenate(ids)

    def decode(self, packed: Iterable[bytes | None]) -> list[bytes]:
        """Bytes of each run of packed ids; unknown ids decode to nothing, null to no bytes."""
        out: list[list[bytes]] = []
        parts: list[np.ndarray] = []
        place: list[int] = []
        held = 0

        def flush() -> None:
            size = [len(p) for p in parts]
            self.db.register("ids", pa.table({"part": np.repeat(np.arange(len(parts), dtype=np.int32), size), "pos": np.arange(sum(size), dtype=np.int32), "id": np.concatenate(parts)}))
            found = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("ids")
            texts = dict(zip(found.column("part").to_pylist(), found.column("text").to_pylist(), strict=True))
            for i, row in enumerate(place):
                out[row].append(texts.get(i, "").encode("latin-1"))
            parts.clear()
            place.clear()

        for row, data in enumerate(packed):
            out.append([])
            ids = np.frombuffer(data or b"", "<u4").astype(np.int32)
            for at in range(0, len(ids), IDS):
                parts.append(ids[at : at + IDS])
                place.append(row)
                held += len(parts[-1])
                if held >= IDS:
                    flush()
                    held = 0
        if parts:
            flush()
        return [b"".join(pieces) for pieces in out]


def _groups(texts, size: int) -> Iterator[list]:
    """Consecutive values of about ``size`` bytes together."""
    group, held = [], 0
    for t in texts:
        group.append(t)
        held += t.as_buffer().size if t.is_valid else 0
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def _mapped(df: DataFrame, source: str, added: list[str], work, ranks: bytes, pattern: str) -> DataFrame:
    if source in added:
        raise ValueError(f"the result needs another column than {source}")
    df = df.drop(*added)
    names = df.columns
    at = names.index(source)
    schema = StructType([*df.schema.fields, *[StructField(c, BinaryType()) for c in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Coder(ranks, pattern)
        try:
            for batch in batches:
                begin = 0
                # results leave in small batches, so that a task holds little more than its input batch
                for group in _groups(batch.column(at), BYTES):
                    done = work(tool, [x.as_py() for x in group])
                    part = batch.slice(begin, len(group))
                    begin += len(group)
                    yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(c, pa.binary()) for c in done]], names=[*names, *added])
        finally:
            tool.close()

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: bytes, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``: the text's token ids as packed little-endian uint32.

    Each match of ``pattern`` is merged on its own; there are no special tokens. Null and empty texts have no ids, rows
    that repeat are encoded alike, an empty table gives no rows. Whole texts are encoded, whatever their length. An
    incoming column named ``ids`` is replaced, any other is kept.
    """
    return _mapped(docs, text, [ids], lambda tool, texts: [tool.encode(texts)], ranks, pattern)


def decode(df: DataFrame, ranks: bytes, pattern: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes of the packed ids; null ids decode to no bytes, unknown ids to nothing.

    An incoming column named ``decoded`` is replaced, any other is kept; an empty table gives no rows.
    """
    return _mapped(df, ids, [decoded], lambda tool, packed: [tool.decode(packed)], ranks, pattern)


def encode_decode(docs: DataFrame, ranks: bytes, pattern: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``ids`` and, decoded from these, ``decoded``, in one pass over the texts; see ``encode`` and ``decode``."""

    def work(tool: Coder, texts: list) -> list[list[bytes]]:
        packed = tool.encode(texts)
        return [packed, tool.decode(packed)]

    return _mapped(docs, text, [ids, decoded], work, ranks, pattern)
