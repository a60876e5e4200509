"""Token counts by a tokenizer compiled into a finite-state transducer.

The tokenizer lowers a text, splits it into words by one pattern and encodes each
word by byte pairs with an end-of-word mark. All of it is one deterministic
machine over characters: a transition says by how much the number of tokens
changes, so a text needs no tokens, only their number.

A state holds, for each place behind the current one from which a token may still
come, the node of the token trie reached from there, the last token before it
and the difference in tokens. That suffices because byte-pair encoding has exactly
one last token for every prefix of a word, namely the one whose pair with the last
token before it would not be encoded otherwise. States are built when a text first
reaches them and numbered in tables of transitions.

Texts are run in many chunks at a time. A chunk's map from entry state to exit state
and count needs only its head, up to the first blank: after a blank the state is the
start, whatever it was. All chunks run at once from the start. A chunk without a blank passes
on a state that depends on its own entry; its map is built for the entries that
runs begun one, two and more chunks before lead to, mostly one, as the tokens fall
into step soon. The maps of a row of such chunks then compose by a parallel prefix scan, which doubles
its stride each time. An entry that no map holds is run from there on.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import text_bytes

END = "</w>"
#: Fixed values of the word pattern: endings that are words of their own after an apostrophe.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = {"r": "e", "v": "e", "l": "l"}
#: Characters that a task runs at a time, and the length of a chunk.
SLICE, CHUNK = 1 << 21, 1 << 10
#: Bounds of the transition table; a full table is built anew from the states in use, inside a text too.
STATES, COLUMNS = 3 << 16, 128
#: Entries for which the map of a chunk is built before the scan.
ENTRIES = 4

_ROOT, _NONE, _START = 0, -1, 0
_KINDS = (regex.compile(r"\p{White_Space}"), regex.compile(r"\p{L}"), regex.compile(r"\p{N}"))


def byte_signs() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use, with their bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """Trie of tokens over bytes (the last byte of a word plus 256) and the test of pairs."""

    def __init__(self, vocabulary: dict[str, int], merges: list) -> None:
        signs = byte_signs()
        self._ids = vocabulary
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self._merges.setdefault((vocabulary[a], vocabulary[b]), (rank, vocabulary[a + b]))
        self._symbols: dict[int, list[int]] = {}
        self._base: dict[int, int] = {}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [_NONE]
        spelled = {}
        for text, number in vocabulary.items():
            body = text.removesuffix(END) or text
            bytes_ = [signs[s] for s in body]
            if body != text:
                bytes_[-1] += 256
            spelled[number] = bytes_
            if len(bytes_) == 1:
                self._base[bytes_[0]] = number
        for number, bytes_ in spelled.items():
            self._symbols[number] = [self._base[b] for b in bytes_]
            if self.encode(self._symbols[number]) == [number]:
                node = _ROOT
                for b in bytes_:
                    node = self._child(node, b)
                self.token[node] = number
        self._fits: dict[int, bool] = {}

    def _child(self, node: int, byte: int) -> int:
        found = self.children[node].get(byte)
        if found is None:
            found = self.children[node][byte] = len(self.children)
            self.children.append({})
            self.token.append(_NONE)
        return found

    def encode(self, parts: list[int]) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        parts = list(parts)
        while len(parts) > 1:
            ranks = [self._merges.get(pair, (1 << 60, 0)) for pair in zip(parts, parts[1:], strict=False)]
            rank, merged = min(ranks)
            if rank == 1 << 60:
                break
            at = ranks.index((rank, merged))
            parts[at : at + 2] = [merged]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side stay as they are."""
        found = self._fits.get(a << 20 | b)
        if found is None:
            found = self._fits[a << 20 | b] = self.encode(self._symbols[a] + self._symbols[b]) == [a, b]
        return found

    def advance(self, core: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], int]:
        """The core of a state after one more byte, and the change in tokens."""
        last = change = None
        after = []
        for place in core:
            node, before, behind = place >> 32, (place >> 12 & 0xFFFFF) - 1, (place & 0xFFF) - 2048
            child = self.children[node].get(byte)
            if child is not None:
                token = self.token[child]
                if last is None and token != _NONE and (before == _NONE or self.fits(before, token)):
                    last, change = token, behind + 1
                after.append((child, before, behind))
        kept = [_packed(n, before, behind - change) for n, before, behind in after if self.children[n]]
        return (*kept, _packed(_ROOT, last, 0)), change


def _packed(node: int, before: int, behind: int) -> int:
    return node << 32 | (before + 1) << 12 | (behind + 2048)


_WORD_START = (_packed(_ROOT, _NONE, 0),)


class Machine:
    """The transducer, built as far as texts have reached."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._pairs = BytePairs(spec["model"]["vocab"], spec["model"]["merges"])
        self._specials = [t["content"] for t in spec["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, self._specials)) or r"(?!)")
        self._column = np.full(0x110000, -1, np.int16)
        self._signs: list[str] = []
        self._column_of(" ")
        self._live: list[np.ndarray] = []
        self._clear()

    def _clear(self) -> None:
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._number(("", (), 0, "", 0))
        self._rows = 1 << 10
        self._table = np.full((self._rows, COLUMNS), -1, np.int32)
        self._others: dict[tuple[int, str], tuple[int, int]] = {}

    def _full(self) -> bool:
        return len(self._states) > STATES or len(self._others) > 4 * STATES

    def _renew(self, *running: np.ndarray) -> None:
        """Begin the tables anew with the states that ``running`` and the live arrays hold, renumbered in place."""
        arrays = [*self._live, *running]
        kept = np.unique(np.concatenate([a.ravel() for a in arrays]))
        states = [self._states[n] for n in kept.tolist()]
        self._clear()
        numbers = np.array([self._number(s) for s in states], np.int32)
        self._room()
        for a in arrays:
            a[...] = numbers[np.searchsorted(kept, a)]

    def _room(self) -> None:
        """Rows of the table for all states."""
        while len(self._states) > self._rows:
            self._rows += self._rows // 3
        if len(self._table) < self._rows:
            more = np.full((self._rows - len(self._table), COLUMNS), -1, np.int32)
            self._table = np.concatenate([self._table, more])

    def _number(self, state: tuple) -> int:
        found = self._numbers.get(state)
        if found is None:
            found = self._numbers[state] = len(self._states)
            self._states.append(state)
        return found

    def _column_of(self, sign: str) -> int:
        if self._column[ord(sign)] < 0 and len(self._signs) < COLUMNS:
            self._column[ord(sign)] = len(self._signs)
            self._signs.append(sign)
        return int(self._column[ord(sign)])

    @staticmethod
    def _kind(sign: str) -> str:
        return next((k for k, p in zip(" LN", _KINDS, strict=True) if p.match(sign)), "O")

    def _grown(self, core: tuple, sign: str) -> tuple[tuple, int, int]:
        """Core after a sign, change in tokens, and further change if the word ends here."""
        *first, last = sign.encode()
        total = 0
        for byte in first:
            core, change = self._pairs.advance(core, byte)
            total += change
        _, ended = self._pairs.advance(core, last + 256)
        core, change = self._pairs.advance(core, last)
        return core, total + change, ended - change

    def _word(self, word: str) -> int:
        state = total = 0
        for sign in word:
            state, change = self._step(state, sign, plain=True)
            total += change
        return total + self._states[state][2]

    def _step(self, number: int, sign: str, plain: bool = False) -> tuple[int, int]:
        """Next state and change in tokens. A state: kind of word, core, change at its end, mark, tokens since the mark."""
        kind, core, end, mark, spent = self._states[number]
        new = self._kind(sign)
        if new == " ":
            return _START, end
        if not plain and mark == "'" and sign in SHORT_ENDINGS or mark in LONG_ENDINGS and LONG_ENDINGS[mark] == sign:
            return _START, self._word("'" + mark.strip("'") + sign) - spent
        if new == kind or plain and kind:
            core, change, ending = self._grown(core, sign)
            return self._number((kind, core, ending, "", 0)), change
        core, change, ending = self._grown(_WORD_START, sign)
        if new == "N":
            return _START, end + change + ending
        if plain:
            return self._number((new, core, ending, "", 0)), change
        if new == "O" and sign == "'":
            return self._number((new, core, ending, "'", change)), end + change
        if mark == "'" and sign in LONG_ENDINGS:
            return self._number((new, core, ending, sign, spent + end + change)), end + change
        return self._number((new, core, ending, "", 0)), end + change

    def _scalar(self, state: int, signs: str) -> tuple[int, list[int]]:
        """One text sign by sign, for the few that the tables do not serve."""
        changes = []
        for sign in signs:
            found = self._others.get((state, sign))
            if found is None:
                found = self._others[state, sign] = self._step(state, sign)
            state, change = found
            changes.append(change)
            if self._full():
                held = np.array([state], np.int32)
                self._renew(held)
                state = int(held[0])
        return state, changes

    def _fill(self, states: np.ndarray, columns: np.ndarray) -> None:
        for key in np.unique(states.astype(np.int64) * COLUMNS + columns).tolist():
            state, column = divmod(key, COLUMNS)
            following, change = self._step(state, self._signs[column])
            self._room()
            self._table[state, column] = following << 9 | (change + 256)

    def _run(self, state: np.ndarray, columns: np.ndarray, out: np.ndarray) -> np.ndarray:
        """All rows of ``columns`` (steps, rows) in step; changes go to ``out``. Returns the exit states."""
        for step in range(len(columns)):
            at = columns[step]
            value = self._table[state, at]
            if value.min() < 0:
                missing = value < 0
                self._fill(state[missing], at[missing])
                value = self._table[state, at]
            state = value >> 9
            out[step] = (value & 511) - 256
            if self._full():
                self._renew(state)
        return state

    def _changes(self, columns: np.ndarray) -> np.ndarray:
        """Changes in tokens along one array of columns that begins at the start and ends with a blank.

        Those of a word that spans chunks are summed up at the beginning of the second.
        """
        rows = -(-len(columns) // CHUNK)
        padded = np.zeros(rows * CHUNK, columns.dtype)
        padded[: len(columns)] = columns
        steps = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        out = np.zeros(steps.shape, np.int16)
        leave = self._run(np.zeros(rows, np.int32), steps, out)
        self._live = [leave]
        found = self._scan(steps, leave, out) if rows > 1 else ()
        self._live = []
        changes = out.T.ravel()[: len(columns)].astype(np.int64)
        for row, total in found:
            changes[row * CHUNK] = total
        return changes

    def _scan(self, steps: np.ndarray, leave: np.ndarray, out: np.ndarray) -> list[tuple[int, int]]:
        """Run the heads of all chunks but the first from their true entries: (chunk, changes of its chain).

        A chain is a chunk whose entry is known and those behind it up to one with a
        blank. ``out`` keeps no change of a head.
        """
        rows = len(leave)
        blank = steps == 0
        has = blank.any(axis=0)
        head = np.where(has, blank.argmax(axis=0) + 1, CHUNK)
        # Heads are mostly short, so only the steps up to the longest are looked at.
        steps_in = out[: head.max()]
        inside = np.arange(len(steps_in))[:, None] < head
        inside[:, 0] = False
        from_start = np.where(inside, steps_in, 0).sum(axis=0, dtype=np.int64)
        steps_in[inside] = 0
        # Chunks of equal signs share their maps.
        alike = np.arange(rows)
        first: dict[bytes, int] = {}
        for row in np.flatnonzero(~has[1:]) + 1:
            alike[row] = first.setdefault(steps[:, row].tobytes(), int(row))

        entry, after = np.zeros((2, ENTRIES, rows), np.int32)
        total = np.zeros((ENTRIES, rows), np.int64)
        guess = np.zeros(rows, np.int32)
        guess[1:] = leave[:-1]
        self._live += [entry, after, guess]
        for n in range(ENTRIES):
            entry[n] = guess
            todo = entry[n] != _START
            after[n], total[n] = leave, from_start
            for m in range(n):
                known = entry[m] == entry[n]
                after[n, known], total[n, known] = after[m, known], total[m, known]
                todo &= ~known
            at = np.flatnonzero(todo)
            _, some, which = np.unique(alike[at] << 32 | entry[n, at], return_index=True, return_inverse=True)
            exits, sums = self._run_heads(alike[at[some]], entry[n, at[some]], steps, head)
            after[n, at], total[n, at] = exits[which], sums[which]
            guess[1:] = np.where(has, leave, after[n])[:-1]
            if (guess == entry[n]).all():
                break
        built = n + 1

        # Each (entry, chunk) points to the pair behind it; pairs that end a chain or lead to an unknown entry point to themselves.
        onward = np.arange(built * rows)
        broken = np.flatnonzero(~has)
        for n in range(built):
            for m in range(built):
                meets = broken[entry[m, broken + 1] == after[n, broken]]
                onward[n * rows + meets] = m * rows + meets + 1
        single = total[:built].ravel()
        passed = np.where(onward == np.arange(built * rows), 0, single)
        while (onward[onward] != onward).any():
            passed = passed + passed[onward]
            onward = onward[onward]

        chain = np.flatnonzero(np.r_[False, True, has[1:-1]])
        end = onward[chain]
        sums = passed[chain] + single[end]
        # Chains that left the maps go on chunk by chunk until they meet one again.
        going = np.flatnonzero(~has[end % rows])
        row, state = end[going] % rows + 1, after.ravel()[end[going]]
        while len(going):
            known = np.full(len(going), -1)
            for n in range(built):
                known = np.where(entry[n, row] == state, n * rows + row, known)
            met = known >= 0
            last, gained = row.copy(), np.zeros(len(row), np.int64)
            last[met] = onward[known[met]] % rows
            gained[met] = passed[known[met]] + single[onward[known[met]]]
            exits, more = self._run_heads(row[~met], state[~met], steps, head)
            left = np.empty(len(row), np.int32)
            left[met] = after.ravel()[onward[known[met]]]
            left[~met], gained[~met] = exits, more
            sums[going] += gained
            on = ~has[last]
            going, row, state = going[on], last[on] + 1, left[on]
        return list(zip(chain.tolist(), sums.tolist(), strict=True))

    def _run_heads(
        self, rows: np.ndarray, entry: np.ndarray, steps: np.ndarray, head: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and changes of the heads of ``rows``, entered in the states ``entry``."""
        order = np.argsort(-head[rows], kind="stable")
        rows, state, total = rows[order], entry[order], np.zeros(len(rows), np.int64)
        self._live.append(state)
        if len(rows) < 8:
            for n, row in enumerate(rows.tolist()):
                signs = "".join(self._signs[c] for c in steps[: head[row], row].tolist())
                state[n], changes = self._scalar(int(state[n]), signs)
                total[n] = sum(changes)
        else:
            for step in range(int(head[rows[0]])):
                live = rows[: np.searchsorted(-head[rows], -step, "left")]
                change = np.zeros((1, len(live)), np.int16)
                state[: len(live)] = self._run(state[: len(live)], steps[step : step + 1, live], change)
                total[: len(live)] += change[0]
        self._live.pop()
        back = np.argsort(order, kind="stable")
        return state[back], total[back]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if self._full():
            self._clear()
        total = np.zeros(len(texts), np.int64)
        parts, sizes = [], []
        for n, text in enumerate(texts):
            if "<|" in text:
                text, special = self._special.subn(" ", text)
                total[n] += special
            signs = normal_form(text)
            columns = self._column[np.frombuffer(signs.encode("utf-32-le"), np.uint32)]
            if len(columns) and columns.min() < 0:
                for sign in sorted({signs[i] for i in np.flatnonzero(columns < 0).tolist()}):
                    self._column_of(sign)
                columns = self._column[np.frombuffer(signs.encode("utf-32-le"), np.uint32)]
                if columns.min() < 0:
                    total[n] += sum(self._scalar(_START, signs + " ")[1])
                    columns = columns[:0]
            parts += [columns, np.zeros(1, np.int16)]
            sizes.append(len(columns) + 1)
        if parts:
            changes = self._changes(np.concatenate(parts))
            total += np.add.reduceat(changes, np.cumsum([0, *sizes[:-1]]))
        return total


def normal_form(text: str) -> str:
    """Composed, lower-case text with plain blanks. Capital sigma is lowered without regard to its place."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if text.isascii():
        return text.lower().translate(_BLANKS)
    return _KINDS[0].sub(" ", text.replace("Σ", "σ").lower())


_BLANKS = {c: " " for c in range(128) if _KINDS[0].match(chr(c))}


@cache
def machine(path: str) -> Machine:
    """One per Python worker: what a text has built serves the next."""
    return Machine(path)


def _slices(batch: list[bytes | None]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for n, text in enumerate(batch):
        size += len(text or b"")
        if size >= SLICE:
            yield first, n + 1
            first, size = n + 1, 0
    if first < len(batch):
        yield first, len(batch)


def count_tokens(
    docs: DataFrame, path: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row, by the word vocabulary at ``path``.

    Strings of special tokens in a text are those tokens. Null texts count as empty
    and have no token; repeated rows are counted each.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = machine(path)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            found = [built.counts([(t or b"").decode() for t in texts[a:b]]) for a, b in _slices(texts)]
            tokens = np.concatenate([np.empty(0, np.int64), *found])
            sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(count, schema)
