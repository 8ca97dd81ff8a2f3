"""A public piece vocabulary in a double-array trie, and dynamic programmes over all segmentations of words.

Words are byte strings in which a space stands for the white-space marker.
They are handled in groups of equal length as byte matrices, so that each step
of the trie and of the programmes is one array operation for a whole group.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0  # FIXED VALUE: an unknown character scores this much below the lowest piece
#: Bytes of one matrix of words (a longer word alone); a programme holds some 24 to 40 bytes for each.
GROUP_CELLS = 1 << 19


class Matches(NamedTuple):
    """Pieces that start at one position: word rows, end positions and piece ids."""

    start: int
    rows: np.ndarray
    ends: np.ndarray
    ids: np.ndarray


class Pieces(NamedTuple):
    """Double-array trie (``base``, ``check``, ``value``) with a score per piece. Its size is that of the vocabulary."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    spelling: list[bytes]

    @staticmethod
    def load(vocabulary: str = VOCABULARY) -> Pieces:
        """Read a vocabulary file that the tokenizer package resolves by name."""
        import public_tokenizers
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(vocabulary)))
        return from_model(model)


def shared_pieces(spark, vocabulary: str = VOCABULARY):
    """The vocabulary as a broadcast, one for all stages of a session."""
    context = spark.sparkContext
    held = context.__dict__.setdefault("railyard_pieces", {})
    if vocabulary not in held:
        held[vocabulary] = context.broadcast(Pieces.load(vocabulary))
    return held[vocabulary]


def from_model(model) -> Pieces:
    n = model.get_piece_size()
    byte_ids, spelling, keys = np.zeros(256, np.int32), [b""] * n, {}
    scores = np.full(n, -np.inf)
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            spelling[i] = bytes([int(name[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            spelling[i] = name.replace(MARKER, " ").encode()
            keys[spelling[i]] = i
            scores[i] = model.get_score(i)
            if " " in spelling[i].decode().lstrip(" "):
                raise ValueError("a piece spans white space, so texts cannot be cut at it")
    unknown = model.unk_id()
    scores[unknown] = scores[np.isfinite(scores)].min() - UNKNOWN_PENALTY
    return Pieces(*double_array(keys), scores, byte_ids, unknown, spelling)


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place each node's children at ``base[node] + byte + 1``, where ``check`` names the node they belong to."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, i in keys.items():
        node = 0
        for byte in key:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][byte]
        ends[node] = i
    size = 2 * len(children) + 4096
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = np.zeros(size, bool)
    taken[0] = True
    place, todo, one, many = {0: 0}, [0], 1, 1
    for node in todo:
        at = place[node]
        value[at] = ends[node]
        codes = np.array(sorted(b + 1 for b in children[node]))
        if len(codes) == 1:
            while taken[max(one, codes[0] + 1)]:
                one += 1
            b = max(one, codes[0] + 1) - codes[0]
        elif len(codes):
            b, many = fit(taken, codes, many)
        else:
            continue
        base[at] = b
        taken[b + codes] = True
        check[b + codes] = at
        place.update((children[node][c - 1], b + c) for c in codes.tolist())
        todo += [children[node][c - 1] for c in codes.tolist()]
    return base, check, value


def fit(taken: np.ndarray, codes: np.ndarray, low: int, window: int = 1024) -> tuple[int, int]:
    """The first base from ``low`` on at which all codes are free, and where to look next time (past full windows)."""
    start = low
    while True:
        free = np.ones(window, bool)
        for c in codes:
            part = ~taken[start + c:start + c + window]
            free[:len(part)] &= part
        at = np.flatnonzero(free)
        if len(at):
            return start + int(at[0]), low
        if start == low and taken[low:low + window].mean() > 0.9:
            low += window
        start += window


def by_length(words: Iterable[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Groups of words of equal length with their byte matrix; empty words are left out."""
    lengths = defaultdict(list)
    for w in words:
        lengths[len(w)].append(w)
    for n, group in lengths.items():
        step = max(1, GROUP_CELLS // max(n, 1))
        for i in range(0, len(group) if n else 0, step):
            part = group[i:i + step]
            yield part, np.frombuffer(b"".join(part), np.uint8).reshape(len(part), n)


def char_length(first: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that begins with this byte."""
    return 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)


def matches(p: Pieces, m: np.ndarray, start: int) -> Matches:
    """All pieces, and the unknown character where no piece is just that character, that begin at ``start``.

    Rows in which ``start`` is inside a character get none.
    """
    length = m.shape[1]
    rows = np.flatnonzero((m[:, start] & 0xC0) != 0x80)
    chars = np.minimum(start + char_length(m[:, start].astype(np.int64)), length)
    single = np.zeros(len(m), bool)
    state, alive, found = np.zeros(len(rows), np.int64), rows, []
    for at in range(start, length):
        step = p.base[state] + m[alive, at].astype(np.int64) + 1
        step[(p.base[state] == 0) | (step >= len(p.check))] = 0
        on = (p.check[step] == state) & (step > 0)
        alive, state = alive[on], step[on]
        if not len(alive):
            break
        ids = p.value[state]
        hit = ids >= 0
        if hit.any():
            found.append((alive[hit], np.full(hit.sum(), at + 1), ids[hit]))
            single[alive[hit][chars[alive[hit]] == at + 1]] = True
    lone = rows[~single[rows]]
    found.append((lone, chars[lone], np.full(len(lone), p.unknown)))
    return Matches(start, *(np.concatenate([f[k] for f in found]) for k in range(3)))


def best_path(p: Pieces, m: np.ndarray) -> np.ndarray:
    """Viterbi: per word the piece ids of its best segmentation, in order, padded with -1 on the right.

    Among equal scores the segmentation whose last piece is longest wins, at each position.
    """
    w, length = m.shape
    best = np.full((w, length + 1), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((w, length + 1), np.int64), np.full((w, length + 1), -1, np.int64)
    for start in range(length):
        x = matches(p, m, start)
        score = best[x.rows, start] + p.scores[x.ids]
        better = score > best[x.rows, x.ends]  # a row has one piece for each end
        r, e = x.rows[better], x.ends[better]
        best[r, e], back[r, e], piece[r, e] = score[better], start, x.ids[better]
    at, steps, rows = np.full(w, length), [], np.arange(w)
    while (on := at > 0).any():
        steps.append(np.where(on, piece[rows, at], -1))
        at = np.where(on, back[rows, at], 0)
    last_first = np.stack(steps, 1) if steps else np.zeros((w, 0), np.int64)
    n = (last_first >= 0).sum(1)
    order = n[:, None] - 1 - np.arange(last_first.shape[1])
    return np.where(order >= 0, np.take_along_axis(last_first, np.maximum(order, 0), 1), -1)


def log_marginal(p: Pieces, m: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Forward algorithm: per word and column of ``logp`` the log of the sum over all segmentations."""
    alpha = np.full((m.shape[1] + 1, len(m), logp.shape[1]), -np.inf)
    alpha[0] = 0
    for start in range(m.shape[1]):
        x = matches(p, m, start)
        alpha[x.ends, x.rows] = np.logaddexp(alpha[x.ends, x.rows], alpha[start, x.rows] + logp[x.ids])
    return alpha[-1]


def expected_pieces(p: Pieces, m: np.ndarray, weights: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Forward and backward: the expected number of times each piece is used, over words with these weights."""
    w, length = m.shape
    alpha, beta = np.full((length + 1, w), -np.inf), np.full((length + 1, w), -np.inf)
    alpha[0], beta[length] = 0, 0
    found = []
    for start in range(length):
        x = matches(p, m, start)
        found.append(x)
        alpha[x.ends, x.rows] = np.logaddexp(alpha[x.ends, x.rows], alpha[start, x.rows] + logp[x.ids])
    counts = np.zeros(len(p.scores))
    for x in reversed(found):
        through = logp[x.ids] + beta[x.ends, x.rows]
        # Several pieces of a row begin here: add them up row by row, in order of their ends.
        np.logaddexp.at(beta[x.start], x.rows, through)
        share = np.exp(alpha[x.start, x.rows] + through - alpha[length, x.rows])
        counts += np.bincount(x.ids, weights[x.rows] * share, minlength=len(counts))
    return counts
