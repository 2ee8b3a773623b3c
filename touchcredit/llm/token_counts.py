"""Token counts by prefix dynamic programming (byte-level BPE).

The exact token count of *every* prefix of a text is stored, one signed 32-bit
step per code point, so "how many tokens are the first n characters" and
"where must I cut to stay within a budget" are answered from the stored array
without encoding anything again.

How the counts arise.  A byte sequence has exactly one token sequence in which
every neighbouring pair is stable (encoding the pair's bytes gives the pair
back); that sequence is its BPE encoding.  So the last token of a prefix is the
one token ending there that is stable after the last token of the prefix it
leaves, and ``count[i] = count[i - len(token)] + 1``.  Stability of a pair is
looked up in a bounded memo.  Texts are cut into units (white space plus the
word it precedes) that never influence each other's tokens; the steps of a
unit are remembered per Python worker (bounded); new words of many texts are
sorted, and each continues the table of the word before it.

Defined cases: NULL text counts as empty (0 bytes, 0 tokens); special strings
inside a text are single tokens, as in the library; NULL ids and repeated rows
give a row each; an empty table gives an empty table; other columns of the
input are not read.
"""

from __future__ import annotations

import functools
import gc
import itertools
import operator
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import bpe
from .common import ship, strings

# A white-space run belongs to the word after it; contractions are words.
_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                           0x202F, 0x205F, 0x3000]))  # the characters that Unicode calls White_Space
_UNIT = regex.compile(rf"'(?:[sdmt]|ll|ve|re)|[{_SPACE}]*[{_SPACE[:5] + _SPACE[6:]}]'(?:[sdmt]|ll|ve|re)"
                      rf"|[{_SPACE}]*\p{{L}}+|[{_SPACE}]*\p{{N}}+|[{_SPACE}]*[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+")
_CONTRACTION = {"'re", "'ve", "'ll"}
_UNEVEN_BREAK = re.compile(r"(?:\A|\s)\n|\n(?:\s|\Z)")
_ENDS = frozenset(",.;:!?")  # single marks behind a word
PAIR_MEMO = 1_000_000
LEARN = 4096  # texts whose new words are sorted together

Pieces = tuple[str | None, list[str]]


class PrefixCounter:
    """Prefix token counts of one byte-level vocabulary."""

    def __init__(self, path: str):
        self.bpe = bpe.ByteBpe(path)
        self.ranks, self.core = self.bpe.ranks, self.bpe.core
        self.tails = _tails(self.ranks)
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.stable: dict[tuple[int, int], bool] = {}
        self.after_space: dict[str, bytes] = {}
        self.alone: dict[str, bytes] = {}
        self.words: dict[str, list[int]] = {}
        self.units: dict[str, bytes] = {}  # steps of units that are one word

    def _is_stable(self, a: int, b: int) -> bool:
        out = self.stable.get((a, b))
        if out is None:
            if len(self.stable) >= PAIR_MEMO:
                self.stable.clear()
            out = self.core.encode_single_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.stable[a, b] = out
        return out

    def word_counts(self, word: str) -> list[int]:
        """Token count of every non-empty code-point prefix of one word."""
        out = self.words.get(word)
        if out is None:
            out = self._word_counts(word)
            if len(word) <= bpe.MEMO_CHARS:
                if len(self.words) >= bpe.MEMO_ENTRIES:
                    self.words.clear()
                self.words[word] = out
        return out

    def _word_counts(self, word: str) -> list[int]:
        raw, last, count = word.encode(), [-1], [0]
        self._extend(raw, last, count)
        return _at_code_points(word, raw, count)

    def _extend(self, raw: bytes, last: list[int], count: list[int]) -> None:
        """Continue a table, which holds the first ``len(last) - 1`` bytes of ``raw``, to its end."""
        ranks, stable = self.ranks.get, self.stable.get
        four, three, two, one = (t.get for t in self.tails)
        for i in range(len(last), len(raw) + 1):
            ends = i > 3 and four(raw[i - 4:i]) or i > 2 and three(raw[i - 3:i]) or i > 1 and two(raw[i - 2:i]) \
                or one(raw[i - 1:i], ())
            for n, token in ends:
                j = i - n
                if j < 0:
                    continue
                if token is None and (token := ranks(raw[j:i])) is None:
                    continue
                before = last[j]
                ok = before < 0 or stable((before, token))
                if ok is None:
                    ok = self._is_stable(before, token)
                if ok:
                    last.append(token)
                    count.append(count[j] + 1)
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends {raw[:i]!r}")

    def learn(self, texts: list[str]) -> list[Pieces]:
        """Remember the steps of all new pieces of some texts, their words in sorted order; returns the pieces.

        Neighbours share a prefix, and the table of a prefix does not depend on
        what follows, so each word continues the table of the one before it.
        """
        collecting = gc.isenabled()
        gc.disable()  # very many small objects and no cycles among them
        try:
            pieces = list(map(_pieces, texts))
            self._learn_pieces(pieces)
        finally:
            if collecting:
                gc.enable()
        return pieces

    def _learn_pieces(self, pieces: list[Pieces]) -> None:
        even, other = set(), set()
        for first, rest in pieces:
            if first is None:
                other.update(rest)
            else:
                other.add(first)
                even.update(rest)
        even = [w for w in even.difference(self.after_space) if len(w) <= bpe.MEMO_CHARS]
        other = [w for w in other.difference(self.alone) if len(w) <= bpe.MEMO_CHARS]
        spaced = {" " + w: w for w in even if w.isalpha()}
        lone = set(spaced.values())
        two, mixed = [], [(self.alone, w, _UNIT.findall(w)) for w in other]  # two: pieces of two units
        for w in even:
            if w not in lone:
                if w[-1:] in _ENDS and w[:-1].isalpha():
                    two.append((w, " " + w[:-1], w[-1]))
                elif w[:1] == "\n" and w[1:].isalpha():
                    two.append((w, "\n", w[1:]))
                else:
                    mixed.append((self.after_space, w, _UNIT.findall(_after_space(w))))
        words = {*spaced, "\n"}
        for _, a, b in two:
            words.add(a)
            words.add(b)
        for _, _, units in mixed:
            words.update(map(_word_of, units))
        self._learn_words(sorted(words.difference(self.units)))
        if len(self.after_space) + len(spaced) + len(two) > bpe.MEMO_ENTRIES:
            self.after_space.clear()
        units = self.units
        known = {w: units[s] for s, w in spaced.items() if s in units}
        known.update([(w, units[a] + units[b]) for w, a, b in two if a in units and b in units])
        self.after_space.update(itertools.islice(known.items(), bpe.MEMO_ENTRIES))
        for memo, w, units in mixed:
            steps = None if self.bpe.special in w else self._of_units(units)
            if steps is not None:
                _keep(memo, w, steps)

    def _learn_words(self, words: list[str]) -> None:
        if len(self.units) + len(words) > bpe.MEMO_ENTRIES:
            self.units.clear()
        before, last, count, step = b"", [-1], [0], []  # step: from one byte's count to the next
        for word in words[:bpe.MEMO_ENTRIES]:
            raw = word.encode()
            k = 0
            for a, b in zip(raw, before):
                if a != b:
                    break
                k += 1
            del last[k + 1:], count[k + 1:], step[k:]
            self._extend(raw, last, count)
            step += map(operator.sub, count[k + 1:], count[k:])
            before = raw
            if word not in _CONTRACTION:
                self.units[word] = (_bytes_of(step) if len(raw) == len(word)
                                    else _packed_steps(_at_code_points(word, raw, count)))

    def _of_units(self, units: list[str]) -> bytes | None:
        """Steps of a piece whose units are single words, or words behind one line break or tab."""
        out = []
        for unit in units:
            if (known := self.units.get(unit)) is None:
                head, rest = self.units.get(unit[0]), self.units.get(unit[1:])
                if unit[0] not in "\n\t" or head is None or rest is None or unit[1] in _SPACE:
                    return None
                out.append(head)
                known = rest
            out.append(known)
        return b"".join(out)

    def _unit_counts(self, unit: str) -> list[int]:
        """Counts of every prefix of a unit, each prefix taken as the end of the text."""
        body = unit.lstrip(_SPACE)
        space = unit[:len(unit) - len(body)]
        out = list(self.word_counts(space)) if space else []
        if not body:
            return out
        settled, lead = 0, space
        if space[-1:] == " ":
            word, lead = " " + body, space[:-1]
        else:
            word, lead = body, space
            if lead:
                settled, lead = self.word_counts(lead[-1])[-1], lead[:-1]
        if lead:
            settled += self.word_counts(lead)[-1]
        counts = list(self.word_counts(word))
        if word in _CONTRACTION:  # "'r" alone is an apostrophe and a letter
            counts[1] = counts[0] + self.word_counts(word[1])[0]
        return out + [settled + c for c in counts[len(word) - len(body):]]

    def _plain_counts(self, text: str) -> list[int]:
        out, base = [], 0
        for unit in _UNIT.findall(text):
            out += [base + c for c in self._unit_counts(unit)]
            base = out[-1]
        return out

    def counts(self, text: str) -> list[int]:
        """Token count of every non-empty prefix of any text, special strings included."""
        special, out, base = self.bpe.special, [], 0
        parts = text.split(special)
        for k, part in enumerate(parts):
            if k < len(parts) - 1:  # inside a special string a prefix is ordinary text
                whole = self._plain_counts(part)
                counts = self._plain_counts(part + special)
                counts[-1] = (whole[-1] if whole else 0) + 1
            else:
                counts = self._plain_counts(part)
            out += [base + c for c in counts]
            base = out[-1] if out else 0
        return out

    def _steps(self, piece: str) -> bytes:
        return _packed_steps(self.word_counts(piece) if piece[1:].isalpha() and piece[0] == " " else self.counts(piece))

    def steps(self, text: str) -> bytes:
        """Little-endian 32-bit steps between the counts of successive prefixes of ``text``."""
        return self.steps_of(_pieces(text))

    def steps_of(self, pieces: Pieces) -> bytes:
        """:meth:`steps` of a text that is in pieces already."""
        first, rest = pieces
        if first is None:
            return bpe._join(self.alone, rest, "", self._steps)
        out = list(map(self.after_space.get, rest))
        if None in out:
            for i, known in enumerate(out):
                if known is None:
                    out[i] = bpe._remember(self.after_space, rest[i], _after_space(rest[i]), self._steps)
        return bpe._remember(self.alone, first, first, self._steps) + b"".join(out)


def _pieces(text: str) -> Pieces:
    """The pieces between single spaces and before single line breaks, the first one apart.

    None and pieces that keep their spaces if some are not single.
    """
    if bpe._UNEVEN_SPACE.search(text):
        return None, bpe._BEFORE_SPACE.split(text)
    if "\n" in text and not _UNEVEN_BREAK.search(text):
        text = text.replace("\n", " \n")
    first, *rest = text.split(" ")
    return first, rest


def _after_space(piece: str) -> str:
    """What a piece behind the first one stands for: a line break keeps its place, others have lost a space."""
    return piece if piece[:1] == "\n" else " " + piece


def _tails(ranks: dict[bytes, int]) -> tuple[dict, dict, dict, dict]:
    """By the last four, three, two bytes and one byte: lengths of the tokens that may end there.

    The order decides nothing (one of them is stable), so those that need no lookup come first, longest first.

    Tokens of at most four bytes come with their id, longer ones are looked up (None).
    """
    by_tail: dict[bytes, set[int]] = {}
    for token in ranks:
        if len(token) >= 4:
            by_tail.setdefault(token[-4:], set()).add(len(token))

    def short(tail: bytes) -> tuple[tuple[int, int], ...]:
        return tuple((n, ranks[tail[-n:]]) for n in range(len(tail), 0, -1) if tail[-n:] in ranks)

    four = {t: (*short(t), *((n, None) for n in sorted(ns - {4}))) for t, ns in by_tail.items()}
    return four, *({t: short(t) for t in ranks if len(t) == k} for k in (3, 2, 1))


def _keep(memo: dict[str, bytes], key: str, value: bytes) -> None:
    if len(memo) >= bpe.MEMO_ENTRIES:
        memo.clear()
    memo[key] = value


def _word_of(unit: str) -> str:
    """What of a unit is looked up as one word: its text with the space right before it."""
    body = unit.lstrip(_SPACE)
    return unit[len(unit) - len(body) - 1:] if unit[:len(unit) - len(body)][-1:] == " " else body


def _at_code_points(word: str, raw: bytes, count: list[int]) -> list[int]:
    """Counts behind every code point, from those behind every byte (entry 0: none)."""
    if len(raw) == len(word):
        return count[1:]
    return [c for i, c in enumerate(count) if i and (i == len(raw) or raw[i] & 0xC0 != 0x80)]


def _packed_steps(counts: list[int]) -> bytes:
    return _bytes_of(map(operator.sub, counts, [0, *counts]))


def _bytes_of(steps: Iterable[int]) -> bytes:
    out = array("i", steps)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@functools.lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def decode_steps(steps: bytes) -> np.ndarray:
    """Stored steps to counts: entry n is the token count of the first n code points (entry 0 is 0)."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "<i4"), dtype=np.int64)])


def count_at(steps: bytes, chars: int) -> int:
    """Exact token count of the first ``chars`` code points."""
    return int(np.frombuffer(steps, "<i4")[:max(0, chars)].sum(dtype=np.int64))


def cut_for_budget(steps: bytes, budget: int) -> int:
    """Length in code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(decode_steps(steps) <= budget)[-1])


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, keep_prefixes: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit, cut_chars`` (and ``prefix_steps``).

    All figures are read from the document's stored prefix counts:
    ``n_tokens`` is the last one, ``over_limit`` says that it exceeds
    ``limit``, ``cut_chars`` is the longest prefix within the limit.
    ``keep_prefixes`` adds the stored array itself (``decode_steps``).
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer)
        for b in batches:
            texts = strings(b.column(1))
            steps = [counter.steps_of(p) for i in range(0, len(texts), LEARN) for p in counter.learn(texts[i:i + LEARN])]
            total = [count_at(s, len(t)) for s, t in zip(steps, texts)]
            cut = [cut_for_budget(s, limit) if n > limit else len(t) for s, n, t in zip(steps, total, texts)]
            cols = [b.column(0).cast(pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(total, pa.int64()), pa.array([n > limit for n in total], pa.bool_()),
                    pa.array(cut, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"]
            if keep_prefixes:
                cols.append(pa.array(steps, pa.binary()))
                names.append("prefix_steps")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = SCHEMA + (", prefix_steps binary" if keep_prefixes else "")
    return docs.select(id_col, text_col).mapInArrow(run, schema)
