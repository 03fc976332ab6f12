"""Token counts from a compiled finite-state transducer.

The vocabulary's merges are compiled into a deterministic transducer over
bytes. After a prefix of a word, the merges' result has one last token, and
a token may follow another exactly when the two, merged as one string, stay
as they are. A state therefore holds, for every start from which a token
could still grow, the place in the vocabulary's trie, the token before that
start and the count there against the count here. A transition carries the
change of the token count, and the last byte of a word leads back to the
start state. States and transitions are built when a text first needs
them and kept in a table per Python worker (emptied past a size bound, which
only costs time).

Texts are read in fixed-width chunks, all chunks of a slice side by side. A
chunk's state map is constant from its first word end on, so the chunks'
interiors run at once from the start state; a prefix scan then hands the
state at each chunk's end to the next chunk, which runs its head (the bytes
up to its first word end) from there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NUMBER, SPACE, byte_symbols, char_classes, id_and_text, slices

LIMIT = 2048
CHUNK = 512
#: States kept by one worker before its table starts anew (some 700 bytes each).
MAX_STATES = 150_000
START = 0
#: Token before the first token of a word.
NONE = -1

#: Texts made of these characters are lower-cased at once; the library's own
#: normalizer handles all others.
_OUTSIDE = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ɏ]")


class Transducer:
    """Lazily built transducer of a byte-level BPE vocabulary with word ends.

    Symbol ``b`` is a byte inside a word, ``256 + b`` a word's last byte.
    """

    def __init__(self, spec: dict, max_states: int = MAX_STATES):
        model = spec["model"]
        end = model["end_of_word_suffix"]
        if not end:
            raise ValueError("the vocabulary has no word ends")
        of = byte_symbols()

        def symbols(token: str) -> tuple[int, ...]:
            last = token.endswith(end)
            body = [of[c] for c in (token[:-len(end)] if last else token)]
            return (*body[:-1], body[-1] + 256) if last else tuple(body)

        special = {t["content"] for t in spec["added_tokens"]}
        self.of_symbols = {symbols(t): i for t, i in model["vocab"].items() if t not in special}
        self.symbols_of = {i: s for s, i in self.of_symbols.items()}
        ids = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        self.inner: set[int] = set()
        nodes = 1
        for s, i in self.of_symbols.items():
            if len(s) > 1 and self.merge(s) != [i]:
                continue  # the merges never give this token
            node = 0
            for x in s:
                self.inner.add(node)
                key = node << 9 | x
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.token_at[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self.max_states = max_states
        self.reset()

    def merge(self, symbols: tuple[int, ...]) -> list[int]:
        """The merges applied to one string of symbols, lowest rank first, leftmost first."""
        parts = [self.of_symbols[s,] for s in symbols]
        while len(parts) > 1:
            ranked = [(self.merges.get(p, (1 << 60, 0))[0], k)
                      for k, p in enumerate(zip(parts, parts[1:]))]
            rank, k = min(ranked)
            if rank == 1 << 60:
                break
            parts[k:k + 2] = [self.merges[parts[k], parts[k + 1]][1]]
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Token ``b`` may stand right after token ``a`` inside a word."""
        if (a, b) not in self.fits:
            self.fits[a, b] = self.merge(self.symbols_of[a] + self.symbols_of[b]) == [a, b]
        return self.fits[a, b]

    def reset(self) -> None:
        self.columns = np.full(512, -1, np.int32)
        self.column_symbols: list[int] = []
        self.width = 0
        self.states: list[tuple] = [((0, NONE, 0),)]
        self.index = {self.states[0]: START}
        self.next = np.full((1024, 0), -1, np.int32)
        self.change = np.zeros((1024, 0), np.int16)
        self._widen(64)

    def _widen(self, width: int) -> None:
        for name, fill in (("next", -1), ("change", 0)):
            old = getattr(self, name)
            new = np.full((old.shape[0], width), fill, old.dtype)
            new[:, :old.shape[1]] = old
            setattr(self, name, new)
        self.width = width

    def _lengthen(self) -> None:
        for name, fill in (("next", -1), ("change", 0)):
            old = getattr(self, name)
            more = np.full_like(old[:len(old) // 2], fill)
            setattr(self, name, np.concatenate([old, more]))

    def columns_of(self, stream: np.ndarray) -> np.ndarray:
        """Table column of each symbol; symbols not met before get a column."""
        met = np.flatnonzero(np.bincount(stream, minlength=512))
        for s in met[self.columns[met] < 0].tolist():
            if len(self.column_symbols) == self.width:
                self._widen(2 * self.width)
            self.columns[s] = len(self.column_symbols)
            self.column_symbols.append(s)
        return self.columns[stream]

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """Next state and change of the token count."""
        grown = [(self.child.get(node << 9 | symbol), before, count)
                 for node, before, count in state]
        last, change = next((self.token_at[node], count + 1) for node, before, count in grown
                            if node in self.token_at
                            and (before == NONE or self.follows(before, self.token_at[node])))
        if symbol >= 256:
            return self.states[START], change
        alive = [(node, before, count - change) for node, before, count in grown
                 if node in self.inner]
        return (*alive, (0, last, 0)), change

    def fill(self, cells: np.ndarray) -> None:
        """Build the transitions of these cells (row * width + column)."""
        for cell in np.unique(cells).tolist():
            row, column = divmod(cell, self.width)
            state, change = self.step(self.states[row], self.column_symbols[column])
            at = self.index.setdefault(state, len(self.states))
            if at == len(self.states):
                self.states.append(state)
                if at == self.next.shape[0]:
                    self._lengthen()
            self.next[row, column] = at
            self.change[row, column] = change

    def run(self, state: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run side by side: ``columns`` is (steps, runs), -1 stays. End states and changes."""
        out = np.zeros(columns.shape, np.int16)
        for j in range(columns.shape[0]):
            c = columns[j]
            live = np.flatnonzero(c >= 0)
            if not live.size:
                continue
            whole = live.size == c.size
            cell = (state if whole else state[live]) * self.width + (c if whole else c[live])
            to = self.next.ravel()[cell]
            if to.min() < 0:
                self.fill(cell[to < 0])
                to = self.next.ravel()[cell]
            if whole:
                state, out[j] = to, self.change.ravel()[cell]
            else:
                state = state.copy()
                state[live] = to
                out[j, live] = self.change.ravel()[cell]
        return state, out

    def changes(self, stream: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Change of the token count at each symbol of a stream of whole words."""
        if not stream.size:
            return np.zeros(0, np.int16)
        if len(self.states) > self.max_states:
            self.reset()
        n = -(-stream.size // chunk)
        columns = np.full(n * chunk, -1, np.int32)
        columns[:stream.size] = self.columns_of(stream)
        columns = columns.reshape(n, chunk)
        ends = np.zeros(n * chunk, bool)
        ends[:stream.size] = stream >= 256
        ends = ends.reshape(n, chunk)
        closed = ends.any(axis=1)
        head = np.where(closed, ends.argmax(axis=1) + 1, chunk)  # symbols up to the first word end
        head[0] = 0
        closed[0] = True
        in_head = np.arange(chunk) < head[:, None]
        state, out = self.run(np.full(n, START), np.where(in_head, -1, columns).T.copy())
        out = out.T.copy()
        # The scan: a chunk is ready when the state at the end of the one before is known.
        known, todo = closed.copy(), np.arange(1, n)
        while todo.size:
            ready = todo[known[todo - 1]]
            steps = int(head[ready].max())
            heads = np.where(in_head[ready, :steps], columns[ready, :steps], -1).T.copy()
            after, change = self.run(state[ready - 1], heads)
            out[ready, :steps] += change.T
            through = ready[~closed[ready]]
            state[through] = after[~closed[ready]]
            known[through] = True
            todo = np.setdiff1d(todo, ready, assume_unique=True)
        return out.ravel()[:stream.size]


#: Endings that the vocabulary's pattern takes with the apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def word_ends(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: its class, and whether it is the last of a word.

    Words are runs of letters, single numbers, runs of other characters,
    and an apostrophe that starts a word together with one of ``ENDINGS``.
    """
    kind = char_classes()[codes]
    padded = np.concatenate([codes, np.zeros(4, codes.dtype)])
    starts = np.ones(codes.size + 4, bool)
    starts[1:codes.size] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    quotes = np.flatnonzero((codes == ord("'")) & starts[:codes.size])
    for ending in ENDINGS:
        hit = quotes
        for k, c in enumerate(ending):
            hit = hit[padded[hit + 1 + k] == ord(c)]
        for k in range(len(ending)):
            starts[hit + 1 + k] = False
        starts[hit + 1 + len(ending)] = True
    starts[codes.size:] = True
    return kind, (kind != SPACE) & starts[1:codes.size + 1]


class Counter:
    """Token counts of texts with one vocabulary file."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.transducer = Transducer(spec)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)))
        self.normalize = Tokenizer.from_file(tokenizer_path).normalizer.normalize_str

    def prepare(self, text: str) -> tuple[str, int]:
        """Normalised text, and the number of special strings taken out of it.

        A special string ends the words at its sides, as a line break does.
        """
        parts = self.special.split(text)
        return "\n".join(p.lower() if not _OUTSIDE.search(p) else self.normalize(p)
                         for p in parts), len(parts) - 1

    def counts(self, texts: list[str]) -> np.ndarray:
        joined = "\n".join(texts)
        if _OUTSIDE.search(joined) or self.special.search(joined):
            pairs = [self.prepare(t) for t in texts]
            texts, extra = [t for t, _ in pairs], np.array([k for _, k in pairs], np.int64)
            joined = "\n".join(texts)
        else:
            joined, extra = joined.lower(), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind, last = word_ends(codes)
        data = np.frombuffer(joined.encode(), np.uint8)
        per_code = None
        if data.size != codes.size:
            per_code = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            after = np.cumsum(per_code)
            final = np.zeros(data.size, bool)
            final[after[last] - 1] = True
            kept = np.repeat(kind != SPACE, per_code)
        else:
            final, kept = last, kind != SPACE
        stream = (data[kept].astype(np.uint16) + (final[kept].astype(np.uint16) << 8))
        upto = np.concatenate([[0], np.cumsum(self.transducer.changes(stream), dtype=np.int64)])
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1  # code points before each text's end
        if per_code is not None:
            ends = np.concatenate([[0], after])[ends]
        at = np.concatenate([[0], np.cumsum(kept)])[ends]
        return np.diff(upto[at], prepend=0) + extra


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    Counts are those of the vocabulary's library without added begin and end
    tokens. NULL and empty texts have 0 bytes and 0 tokens; repeated rows are
    counted each; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for batch in slices(batches):
            n_bytes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            counts = counter.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(counts, pa.int64()), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
