"""Terms of texts, cut and counted inside a task.

Texts come as lists of words (between spaces) and of tokens (what counts as a
word).  The n-grams of a word are made once per distinct word of a piece, and
counted by sorting numbers: no string is hashed per occurrence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

CHAR_NGRAMS = (3, 5)
#: Rows handed on at once.
ROWS_AT_ONCE = 1 << 16

# Distinct terms, and for each of their members: the term's place, the member, how often it has it.
Counts = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]


def char_grams(word: str) -> list[str]:
    """The character n-grams of a word between spaces, as ``tfidf.char_terms`` makes them."""
    low, high = CHAR_NGRAMS
    padded = f" {word} "
    return [
        padded[at : at + n]
        for n in range(low, min(high, len(padded)) + 1)
        for at in range(len(padded) - n + 1)
    ]


def spans(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the chosen lists: how long each is, and the places of all their members."""
    first = starts[which]
    size = starts[which + 1] - first
    ends = np.cumsum(size)
    return size, np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _totals(term: np.ndarray, member: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``times`` added up per term and member, in their order."""
    if not len(term):
        return term, member, times
    width = int(member.max()) + 1
    both = term * width + member
    digits = int(times.max()).bit_length()
    if int(both.max()).bit_length() + digits < 63:
        # Sorting the numbers themselves is several times faster than sorting their places.
        packed = np.sort(both << digits | times)
        both, times = packed >> digits, packed & ((1 << digits) - 1)
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        return both[first] // width, both[first] % width, np.add.reduceat(times, first)
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    return both[first] // width, both[first] % width, np.add.reduceat(times[order], first)


def _flat(lists: pa.Array, members: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct strings of the lists, and the place of each string and its member; a null list is empty."""
    encoded = lists.flatten().dictionary_encode()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype("i8"), np.repeat(members, sizes)


def count_chars(words: pa.Array, members: np.ndarray) -> Counts:
    """Counts of the character n-grams of ``words``, a list per row, by the row's member."""
    distinct, word, member = _flat(words, members)
    word, member, times = _totals(word, member, np.ones(len(word), "i8"))
    spelt = distinct.to_pylist()
    terms, code, starts = _numbered_grams(spelt) or _listed_grams(spelt)
    size, at = spans(starts, word)
    return terms, *_totals(code[at], np.repeat(member, size), np.repeat(times, size))


def _listed_grams(words: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct n-grams of the words; for each n-gram of each word its place; where each word's begin."""
    grams = [char_grams(w) for w in words]
    starts = np.append(0, np.cumsum([len(g) for g in grams], dtype="i8"))
    spelt = pa.array([g for of_word in grams for g in of_word], pa.string()).dictionary_encode()
    return spelt.dictionary, spelt.indices.to_numpy(zero_copy_only=False).astype("i8"), starts


def _numbered_grams(words: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
    """``_listed_grams`` with an n-gram as one number, of a digit per character; None if the alphabet is too large."""
    low, high = CHAR_NGRAMS
    points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), "u4")
    alphabet, digit = np.unique(points, return_inverse=True)
    base = len(alphabet) + 1
    if not len(words) or alphabet[0] == 0 or base**high >= 1 << 62:
        return None
    digit = digit.astype("i8") + 1
    length = np.fromiter(map(len, words), "i8", len(words)) + 2
    ends = np.cumsum(length)
    left = np.repeat(ends, length) - np.arange(len(points))  # characters from here to the end of the word
    of, codes = [], []
    for n in range(low, high + 1):
        at = np.flatnonzero(left >= n)
        code = digit[at]
        for k in range(1, n):
            code = code * base + digit[at + k]
        of.append(at)
        codes.append(code)
    of, codes = np.concatenate(of), np.concatenate(codes)
    of = np.searchsorted(ends, of, side="right")
    order = np.argsort(of, kind="stable")
    distinct, code = np.unique(codes[order], return_inverse=True)
    # The digits of a number from the last one; a shorter n-gram has zeros, which end its text, in front of them.
    letters, spelt, rest = np.append(np.uint32(0), alphabet), np.zeros((len(distinct), high), "u4"), distinct
    for k in range(high - 1, -1, -1):
        rest, last = np.divmod(rest, base)
        spelt[:, k] = letters[last]
    used = (spelt > 0).sum(axis=1)
    for n in range(low, high):
        short = np.flatnonzero(used == n)
        spelt[short, :n], spelt[short, n:] = spelt[short, high - n :], 0
    terms = pa.array(spelt.view(f"U{high}").ravel().tolist(), pa.string())
    return terms, code.astype("i8"), np.append(0, np.cumsum(np.bincount(of, minlength=len(words))))


def count_words(tokens: pa.Array, members: np.ndarray) -> Counts:
    """Counts of ``tokens``, a list per row, and of their neighbours in a row."""
    distinct, token, member = _flat(tokens, members)
    row = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    here = np.flatnonzero(row[1:] == row[:-1])
    pairs, pair = np.unique(token[here] * len(distinct) + token[here + 1], return_inverse=True)
    spelt = distinct.to_pylist()
    both = [f"{spelt[a]} {spelt[b]}" for a, b in zip(*(x.tolist() for x in np.divmod(pairs, max(1, len(distinct)))))]
    terms = pa.concat_arrays([distinct, pa.array(both, pa.string())])
    code, member = np.append(token, len(distinct) + pair), np.append(member, member[here])
    return terms, *_totals(code, member, np.ones(len(code), "i8"))


def counted(rows: pa.Table, members: np.ndarray) -> dict[str, Counts]:
    """Counts per space of ``rows(words, tokens)``; rows of one member are counted as one text."""
    words, tokens = (_whole(rows.column(c)) for c in ("words", "tokens"))
    return {"char": count_chars(words, members), "word": count_words(tokens, members)}


def _whole(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)


def _pieces(batches: Iterator[pa.RecordBatch], ids: Sequence[str], most: int) -> Iterator[tuple[pa.Table, np.ndarray, bool]]:
    """Rows of about ``most`` characters, the number of each one's text, and whether the last text ends here.

    Rows come in the order of ``ids``; those with the same ids are one text.
    """
    held, numbers, last, size = [], [], None, 0
    for batch in batches:
        begin = 0
        keys = zip(*(batch.column(c).to_pylist() for c in ids))
        for at, (key, chars) in enumerate(zip(keys, batch.column("chars").to_pylist())):
            if size >= most:
                held.append(batch.slice(begin, at - begin))
                yield pa.Table.from_batches(held), np.array(numbers), key != last
                held, numbers, begin, size = [], [], at, 0
            numbers.append(numbers[-1] + (key != last) if numbers else 0)
            last, size = key, size + chars
        held.append(batch.slice(begin))
    if numbers:
        yield pa.Table.from_batches(held), np.array(numbers), True


LISTED = "char_terms array<string>, char_ns array<int>, word_terms array<string>, word_ns array<int>"


def list_texts(id_col: str, most: int):
    """``(id_col, LISTED)``: the terms of each text and how often it has them, from rows (id_col, words, tokens, chars).

    No two rows have the same id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, members, _ in _pieces(batches, [id_col], most):
            columns = {id_col: rows.column(id_col)}
            for space, (terms, term, member, n) in counted(rows, members).items():
                order = np.argsort(member, kind="stable")
                ends = np.append(0, np.cumsum(np.bincount(member, minlength=rows.num_rows))).astype("i4")
                for what, values in (("terms", terms.take(pa.array(term[order]))), ("ns", pa.array(n[order], pa.int32()))):
                    columns[f"{space}_{what}"] = pa.ListArray.from_arrays(pa.array(ends), values)
            yield from pa.table(columns).to_batches(ROWS_AT_ONCE)

    return run


def count_texts(ids: Sequence[str], most: int, summed: bool = False):
    """``(ids, space, term, n)`` from rows ``(ids, words, tokens, chars)`` in the order of ``ids``.

    A piece of texts is held at a time.  Of a text that goes on in the next one,
    the counts so far are carried over.  ``summed`` gives ``(space, term, df, tf)``,
    a row per term of a piece: the texts that end in it with the term, and its occurrences there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: Counter = Counter()

        def out(names: pa.Table, member: np.ndarray, space: str, terms: pa.Array, term: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            if summed:  # terms are in order
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else term
                df, tf = np.diff(np.append(first, len(term))), np.add.reduceat(n, first) if len(first) else n
                columns = {"space": pa.repeat(space, len(df)), "term": terms.take(pa.array(term[first])), "df": df, "tf": tf}
            else:
                mine = names.take(pa.array(member))
                columns = {**{c: mine.column(c) for c in ids}, "space": pa.repeat(space, len(n)), "term": terms.take(pa.array(term)), "n": n}
            yield from pa.table(columns).to_batches(ROWS_AT_ONCE)

        for rows, members, closed in _pieces(batches, ids, most):
            first = np.flatnonzero(np.append(True, members[1:] != members[:-1]))
            names, end = rows.select(list(ids)).take(pa.array(first)), len(first)
            going_on = bool(carried)
            for space, (terms, term, member, n) in counted(rows, members).items():
                aside = member == -1
                if going_on:
                    aside |= member == 0
                if not closed:
                    aside |= member == end - 1
                # A text that ended in this piece leaves with what was carried of it, see below.
                kept = np.flatnonzero(~aside)
                yield from out(names, member[kept], space, terms, term[kept], n[kept])
                for who in {*([0] if going_on else []), *([] if closed else [end - 1])}:
                    mine = np.flatnonzero(member == who)
                    for t, times in zip(terms.take(pa.array(term[mine])).to_pylist(), n[mine].tolist()):
                        carried[who, space, t] += times
            done = {k: v for k, v in carried.items() if k[0] == 0 and (end > 1 or closed)}
            for space in ("char", "word"):
                mine = [(t, v) for (_, s, t), v in done.items() if s == space]
                if mine:
                    spelt, n = pa.array([t for t, _ in mine], pa.string()), np.array([v for _, v in mine])
                    yield from out(names, np.zeros(len(n), "i8"), space, spelt, np.arange(len(n)), n)
            # In the next piece, the text that goes on is the first.
            carried = Counter({(0, s, t): v for k, v in carried.items() if k not in done for _, s, t in [k]})

    return run
