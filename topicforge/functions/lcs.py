"""Longest-common-subsequence helpers for ROUGE-L (used inside a pandas UDF).

The LCS length uses the bit-parallel recurrence (one big-integer word per
token of the first sequence), so a pair costs O(n * m / 64) machine
operations; the union-LCS of ROUGE-Lsum backtracks over the same bit rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

#: Of a UTF-8 byte, what lower case and the tokenizer leave: letters and digits, the line feed, else a space.
_PLAIN = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() or b == 10 else 32 for b in range(256))


def _plain(text: str) -> str:
    """The text in lower case with a space for each byte of what is neither alphanumeric nor a line feed.
    Only the Kelvin sign and the capital I with a dot become an ASCII letter though they are none."""
    data = text.encode("utf-8", "replace")
    if len(data) > len(text):
        data = data.replace(b"\xe2\x84\xaa", b"k").replace(b"\xc4\xb0", b"i ")
    return data.translate(_PLAIN).decode("ascii")


def tokenize(text: str | None) -> list[str]:
    """Lower case, non-alphanumerics to spaces, split (the metric tokenizer)."""
    return _plain(text).split() if text else []


def _masks(b: Sequence[str]) -> dict[str, int]:
    m: dict[str, int] = {}
    for j, tok in enumerate(b):
        m[tok] = m.get(tok, 0) | (1 << j)
    return m


_kept_masks = lru_cache(maxsize=256)(_masks)


def _rows(a: list[str], b: list[str], masks: dict[str, int] | None = None) -> list[int]:
    """V_0..V_n; LCS(a[:i], b[:j]) = j - popcount(V_i & (2^j - 1))."""
    masks = _masks(b) if masks is None else masks
    full = (1 << len(b)) - 1
    v = full
    rows = [v]
    for tok in a:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def lcs_length(a: list[str], b: list[str]) -> int:
    if not a or not b:
        return 0
    seen = set(b)
    v = _rows([tok for tok in a if tok in seen], b)[-1]
    return len(b) - v.bit_count()


def lcs_indices(ref: list[str], can: list[str]) -> list[int]:
    """Indices into ``ref`` of one LCS, backtracking from the end and
    preferring to drop a ``can`` token on ties (the usual ROUGE choice).
    A ``ref`` token that ``can`` lacks leaves the bits as they are and is
    dropped wherever the backtrack meets it, so only the others are looked
    at; one alone is the whole LCS."""
    if ref == can:
        return list(range(len(ref)))
    masks = _kept_masks(tuple(can))  # a predicted sentence meets many of the reference
    kept = [i for i, tok in enumerate(ref) if tok in masks]
    if len(kept) < 2:
        return kept
    rows = _rows([ref[i] for i in kept], can, masks)
    j, out = len(can), []
    low = (1 << j) - 1
    rest = j - rows[-1].bit_count()
    for i in range(len(kept), 0, -1):
        # The last place in can[:j] of the token.  Where it is not j itself, the token is taken if without it
        # LCS(i, j) is shorter; all between is dropped then, as it changes no length.
        at = (masks[ref[kept[i - 1]]] & low).bit_length()
        if at and (at == j or (rows[i - 1] & low).bit_count() > (rows[i] & low).bit_count()):
            out.append(kept[i - 1])
            rest -= 1
            if not rest:
                break
            j = at - 1
            low = (1 << j) - 1
    out.reverse()
    return out


def _prf(hits: int, n_pred: int, n_ref: int) -> tuple[float, float, float]:
    p = hits / n_pred if n_pred else 0.0
    r = hits / n_ref if n_ref else 0.0
    f = 2 * p * r / (p + r) if p + r > 0 else 0.0
    return p, r, f


def rouge_l_tokens(pred: list[str], ref: list[str]) -> tuple[float, float, float]:
    """(precision, recall, f1) of the LCS between the two token lists."""
    if not pred or not ref:
        return 0.0, 0.0, 0.0
    return _prf(lcs_length(ref, pred), len(pred), len(ref))


def rouge_l(prediction: str | None, reference: str | None) -> tuple[float, float, float]:
    """(precision, recall, f1) of the LCS between the tokens of two texts."""
    return rouge_l_tokens(tokenize(prediction), tokenize(reference))


def sentence_tokens(text: str | None) -> list[list[str]]:
    """The tokens of each non-empty line."""
    return [line.split() for line in _plain(text).split("\n") if line] if text else []


def rouge_lsum_tokens(pred_s: list[list[str]], ref_s: list[list[str]]) -> tuple[float, float, float]:
    """Summary-level LCS over the sentences of two texts (union LCS, each
    token counted at most as often as it occurs on both sides).  Of a
    reference sentence only tokens can count of which the prediction still
    has some, and with none left no more of the reference is looked at; a
    predicted sentence is compared only where it could add one of them to the
    union."""
    m = sum(map(len, ref_s))
    n = sum(map(len, pred_s))
    if not m or not n:
        return 0.0, 0.0, 0.0
    left = dict(Counter(chain.from_iterable(pred_s)))  # an occurrence in the reference is met once, so it bounds itself
    sides = {tuple(c): (c, set(c)) for c in pred_s}
    hits = 0
    for r in ref_s:
        if left.keys().isdisjoint(r):
            continue
        may = [i for i, tok in enumerate(r) if tok in left]
        if tuple(r) in sides:
            union = may
        else:
            wait = set(may)
            words = {r[i] for i in may}
            for c, seen in sides.values():
                if words.isdisjoint(seen):
                    continue
                kept = [i for i, tok in enumerate(r) if tok in seen]
                rest = iter(c)
                if len(kept) == 1 or all([r[i] in rest for i in kept]):  # in the same order there: the whole LCS
                    wait.difference_update(kept)
                else:
                    wait.difference_update(lcs_indices(r, c))
                if not wait:
                    break
                words = {r[i] for i in wait}
            union = [i for i in may if i not in wait]
        for i in union:
            tok = r[i]
            if tok in left:
                hits += 1
                left[tok] -= 1
                if not left[tok]:
                    del left[tok]
        if not left:
            break
    return _prf(hits, n, m)


def rouge_lsum(prediction: str | None, reference: str | None) -> tuple[float, float, float]:
    """``rouge_lsum_tokens`` of the lines of two texts."""
    return rouge_lsum_tokens(sentence_tokens(prediction), sentence_tokens(reference))
