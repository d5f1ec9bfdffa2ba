"""Token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is compiled into two deterministic transducers.

* ``PreTokens`` reads one symbol per character (its class, with the constant
  lookahead the split pattern needs) and marks where a pre-token starts. Many
  texts are laid end to end and cut into chunks of equal length; each chunk's
  map from every entry state to its exit state is computed for all chunks at
  once, the maps are composed by a parallel prefix scan, and a second sweep
  from the entry states found that way marks the starts.
* ``TokenCounts`` reads the bytes of a pre-token. Its transitions carry the
  change in the number of emitted tokens, so their sum is the count. A state
  holds, for the positions that a vocabulary token may still span, the last
  token of the tokenization that ends there: the last token of a longer prefix
  is the one whose left neighbour it is compatible with. States and
  transitions are compiled when a text first needs them.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import batches_by_size, worker_cache

CHUNK = 64
BATCH_BYTES = 2 << 20
#: Pre-tokens and transducer states a worker remembers before it starts anew (about 300 MB).
MEMO_TOKENS = 1_000_000
MEMO_STATES = 500_000

# symbols of the first transducer
LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE_LAST, WHITE_LAST, WHITE, RESET = range(9)
# its states: after a reset or a closed pre-token; inside a run of letters, numbers or other
# characters; inside white space; after a space that opens the next pre-token; one or two
# characters of a contraction to come
END, IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, OPEN, ONE_MORE, TWO_MORE = range(8)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 where a pre-token starts) by state and symbol."""
    after = np.zeros((8, 9), dtype=np.uint8)
    starts = np.zeros((8, 9), dtype=np.uint8)
    for state in range(8):
        for symbol, run in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER),
                            (QUOTE1, IN_OTHER), (QUOTE2, IN_OTHER)):
            if state in (run, OPEN):
                after[state, symbol] = run
            else:
                after[state, symbol] = {QUOTE1: ONE_MORE, QUOTE2: TWO_MORE}.get(symbol, run)
                starts[state, symbol] = 1
        after[state, SPACE_LAST], starts[state, SPACE_LAST] = OPEN, 1
        after[state, WHITE_LAST], starts[state, WHITE_LAST] = END, 1
        after[state, WHITE], starts[state, WHITE] = IN_WHITE, state != IN_WHITE
        after[state, RESET] = END
    # the letters of a contraction follow its quote for certain
    after[ONE_MORE, LETTER], starts[ONE_MORE, LETTER] = END, 0
    after[TWO_MORE, LETTER], starts[TWO_MORE, LETTER] = ONE_MORE, 0
    return after, starts


def character_classes() -> np.ndarray:
    """Class of every code point: 0 other, 1 letter, 2 number, 3 white space.

    The regex package proposes the classes; the tokenizers library, whose
    Unicode tables may be of another version, has the last word: a string of
    one class is a single run there, and runs that break off are asked about
    one by one."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel
    runs = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for value, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, points)]] = value
    for value, lead in ((0, "!"), (1, "a"), (2, "1"), (3, "\n")):
        same = lead + "".join(c for c in map(chr, np.flatnonzero(kinds == value)) if not "\ud800" <= c <= "\udfff")
        found = runs(same)
        for _, (start, end) in found if len(found) > 1 else ():
            run = same[start:end]
            right = next((k for k, x in ((0, "!"), (1, "a"), (2, "1")) if len(runs(x + run)) == 1), 3)
            kinds[[ord(c) for c in run]] = right
    return kinds


class PreTokens:
    def __init__(self, classes: np.ndarray):
        self.classes = classes
        after, starts = _machine()
        self.after, self.starts = after.ravel(), starts.ravel()

    def symbols(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols of texts laid end to end; each text is followed by one
        character that stands for a reset, at ``ends``."""
        kinds = self.classes[points]
        kinds[ends] = 9
        out = np.full(len(points), OTHER, dtype=np.uint8)
        out[kinds == 1] = LETTER
        out[kinds == 2] = NUMBER
        white = np.flatnonzero(kinds == 3)
        last = ~np.isin(kinds[white + 1], (3, 9))
        out[white] = np.where(last, np.where(points[white] == 32, SPACE_LAST, WHITE_LAST), WHITE)
        out[ends] = RESET
        quotes = np.flatnonzero(points == 39)
        quotes = quotes[out[quotes] == OTHER]
        if len(quotes):
            first = points[quotes + 1]
            second = points[np.minimum(quotes + 2, len(points) - 1)]
            inside = out[quotes + 1] == LETTER
            out[quotes[inside & np.isin(first, [ord(c) for c in "stmd"])]] = QUOTE1
            pair = np.zeros(len(quotes), dtype=bool)
            for a, b in ("re", "ve", "ll"):
                pair |= (first == ord(a)) & (second == ord(b))
            out[quotes[inside & pair]] = QUOTE2
        return out

    def start_marks(self, symbols: np.ndarray) -> np.ndarray:
        """Positions where a pre-token starts."""
        n = len(symbols)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, RESET, dtype=np.uint8)
        grid[:n] = symbols
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        maps = np.repeat(np.arange(8, dtype=np.uint8)[:, None], rows, axis=1)
        for column in grid:
            maps = self.after[maps * np.uint8(9) + column]
        # inclusive prefix scan: maps[:, i] becomes the map of chunks 0..i
        step = 1
        while step < rows:
            maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step], axis=0)
            step *= 2
        state = np.concatenate(([END], maps[END, :-1])).astype(np.uint8)
        marks = np.empty((CHUNK, rows), dtype=np.uint8)
        for j, column in enumerate(grid):
            at = state * np.uint8(9) + column
            marks[j] = self.starts[at]
            state = self.after[at]
        return np.flatnonzero(marks.T.ravel()[:n])


class TokenCounts(dict):
    """Pre-token -> number of tokens, compiled from the vocabulary and merges."""

    def __init__(self, spec: dict):
        self.ranks, self.split = {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = _raw(a), _raw(b)
            self.ranks[a, b] = rank
            self.split.setdefault(a + b, (rank, a, b))
        self.tokens = {_raw(t) for t in spec["model"]["vocab"]}
        self.heads = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.whole: dict = {}
        self.joined: dict = {}
        self.reset()

    def reset(self) -> None:
        self.states = [((), b"")]
        self.numbers = {self.states[0]: 0}
        self.steps: dict = {}

    def merge(self, word: bytes) -> list[bytes]:
        """The merges applied to a whole word, lowest rank first."""
        parts = [word[k:k + 1] for k in range(len(word))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get((parts[k], parts[k + 1]), 1 << 60), k) for k in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def own(self, token: bytes) -> bool:
        """Whether the merges turn the token's bytes into this one token."""
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = self.merge(token) == [token]
        return found

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together.

        Undoes the merges next to the boundary, latest first. The tokens join
        if a pair met on the way could merge before the pieces beside it had
        grown on."""
        key = left, right
        found = self.joined.get(key)
        if found is not None:
            return found
        if len(self.joined) > MEMO_STATES:
            self.joined.clear()
        base = (-1, b"", b"")
        bound = 1 << 60
        while True:
            rank = self.ranks.get((left, right))
            if rank is not None and rank < bound:
                found = False
                break
            (l_rank, _, l_part), (r_rank, r_part, _) = self.split.get(left, base), self.split.get(right, base)
            if l_rank < 0 and r_rank < 0:
                found = True
                break
            # of equal ranks the merge further left comes first
            if l_rank > r_rank:
                left, bound = l_part, l_rank
            else:
                right, bound = r_part, r_rank + 1
        self.joined[key] = found
        return found

    def compile_step(self, number: int, byte: int) -> tuple[int, int]:
        """(next state, change in the count) of a transition not met before.

        A state is (history, tail): ``tail`` the longest suffix read that
        starts some token, ``history`` for each position from its start to the
        present (token that ends there or None at the word's start, count there
        relative to the present one)."""
        history, tail = self.states[number]
        if not history:
            history = ((None, 0),)
        tail += bytes((byte,))
        while tail not in self.heads:
            tail = tail[1:]
        history = history[-len(tail):]
        for k in range(len(tail)):
            token, (left, before) = tail[k:], history[k]
            if token in self.tokens and (left is None or self.compatible(left, token)) and self.own(token):
                change = before + 1
                break
        else:
            raise ValueError("no token ends here: the vocabulary lacks a byte")
        made = tuple((t, c - change) for t, c in history) + ((token, 0),)
        state = made, tail
        number_to = self.numbers.get(state)
        if number_to is None:
            number_to = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number_to, change

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_TOKENS:
            self.clear()
        if len(self.states) >= MEMO_STATES:
            self.reset()
        state = count = 0
        for byte in word.encode():
            key = state << 8 | byte
            step = self.steps.get(key)
            if step is None:
                step = self.steps[key] = self.compile_step(state, byte)
            state, change = step
            count += change
        self[word] = count
        return count


def _raw(token: str, table: dict = {}) -> bytes:  # noqa: B006 - filled once
    """Bytes of a vocabulary entry: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    if not table:
        kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        table.update({chr(b): b for b in kept})
        table.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(kept))})
    return bytes(table[c] for c in token)


class Counter:
    """Token counts of texts under a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, classes: np.ndarray):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only plain byte-level BPE is compiled")
        if spec["model"].get("ignore_merges"):
            raise ValueError("ignore_merges is not compiled")
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens with word or strip rules are not compiled")
        self.pre = PreTokens(classes)
        self.counts = TokenCounts(spec)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string inside a text is one token."""
        owner, pieces = [], []
        out = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            parts = [text]
            for mark in self.special:
                parts = [y for x in parts for y in x.split(mark)]
            out[k] = len(parts) - 1
            for x in parts:
                if x:
                    owner.append(k)
                    pieces.append(x)
        if not pieces:
            return out
        whole = "\0".join(pieces) + "\0"
        points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(sizes + 1) - 1
        starts = self.pre.start_marks(self.pre.symbols(points, ends))
        first = np.concatenate(([0], ends[:-1] + 1))
        # a pre-token ends where the next one starts, or at its piece's end
        at = np.searchsorted(starts, first)
        stops = np.append(starts[1:], ends[-1])
        last = np.append(at[1:], len(starts)) - 1
        stops[last] = ends
        n = np.fromiter(map(self.counts.__getitem__, map(whole.__getitem__, map(slice, starts.tolist(), stops.tolist()))),
                        dtype=np.int64, count=len(starts))
        np.add.at(out, owner, np.add.reduceat(n, at))
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every whole text.

    Null counts as the empty text: 0 bytes, 0 tokens. ``path`` names the
    tokenizer file on every machine. Rows with null or repeated ids are counted
    like any other; other columns are not read."""
    kind = dict(docs.dtypes)["doc_id"]
    classes = character_classes()

    def run(batches):
        import pyarrow as pa
        counter = worker_cache().get(path)  # compiled once in a worker's life
        if counter is None:
            counter = worker_cache()[path] = Counter(path, classes)
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                texts = part.column(1).to_pylist()
                n = counter.count([(t or b"").decode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n),
                     pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"))
