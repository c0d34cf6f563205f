"""A linear-chain conditional random field over word-shape features, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
EDGES = "\"'`,;:!?<>{}|*#%&$~"
#: Values of each feature of a word; features of the words before and after count separately.
SIZES = {"digits": 24, "letters": 4, "dots": 6, "marks": 64, "length": 8, "said": 4, "sum": 2, "octets": 2}
AROUND = (-1, 0, 1)
SAID = {"at": 1, "[at]": 2, "(at)": 2, "{at}": 2, "dot": 3, "[dot]": 3, "(dot)": 3, "{dot}": 3}


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def describe(word: str) -> tuple[int, ...]:
    """The word's features, in the order of SIZES."""
    core = word.strip(EDGES)
    digits = "".join(re.findall("[0-9]", core))
    letters = (any(map(str.islower, core)) and 1) + (any(map(str.isupper, core)) and 2)
    marks = sum(1 << k for k, m in enumerate("@+()-") if m in core) + 32 * any(not c.isalnum() and c not in "@+()-." for c in core)
    octets = re.fullmatch(r"\(?\[?([0-9]{1,3})(?:(?:\.|\[\.\])([0-9]{1,3})){3}\.?\]?\)?", core) is not None
    return (
        min(len(digits), 23), letters, min(core.count("."), 5), marks, min(len(core).bit_length(), 7),
        SAID.get(core.lower().rstrip("."), 0), int(16 <= len(digits) <= 19 and luhn(digits)), int(octets),
    )


OFFSETS = np.cumsum([0, *SIZES.values()])
SPAN = int(OFFSETS[-1]) + 1


def feature_ids(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of weights for each word of chains laid end to end: its own features and its neighbours' in the chain.
    ``words`` has a row of ``describe`` for each word."""
    own = words + OFFSETS[:-1]
    out = []
    ends = np.cumsum(lengths)
    for k, step in enumerate(AROUND):
        moved = np.full_like(own, OFFSETS[-1])
        if step == 0:
            moved = own
        elif step < 0:
            moved[1:] = own[:-1]
            moved[(ends - lengths)[lengths > 0]] = OFFSETS[-1]
        else:
            moved[:-1] = own[1:]
            moved[(ends - 1)[lengths > 0]] = OFFSETS[-1]
        out.append(moved + k * SPAN)
    return np.concatenate(out, 1)


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def emissions(model: Model, ids: np.ndarray) -> np.ndarray:
    out = np.zeros((len(ids), len(TAGS)))
    for column in ids.T:
        out += model.weights[column]
    return out


def laid_out(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values by chain and step, padded, and which are real."""
    real = np.arange(lengths.max())[None, :] < lengths[:, None]
    out = np.zeros((*real.shape, *values.shape[1:]), values.dtype)
    out[real] = values
    return out, real


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(labelled: pd.DataFrame, rounds: int = 110, rate: float = 0.15, decay: float = 2e-3) -> Model:
    """The model with the largest penalised likelihood of a table of chain, position, word, tag, by Adam."""
    rows = labelled.sort_values(["chain", "position"])
    lengths = rows.groupby("chain").size().to_numpy()
    ids, real = laid_out(feature_ids(np.array([describe(w) for w in rows["word"]]), lengths), lengths)
    tags, _ = laid_out(rows["tag"].map(TAGS.index).to_numpy(), lengths)
    n, steps, k = len(lengths), real.shape[1], len(TAGS)
    gold = np.eye(k)[tags] * real[..., None]
    gold_moves = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    params = {"weights": np.zeros((SPAN * len(AROUND), k)), "moves": np.zeros((k, k)), "first": np.zeros(k)}
    memory = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in params.items()}
    for step in range(1, rounds + 1):
        e = params["weights"][ids].sum(2)
        forward, backward = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        forward[:, 0] = params["first"] + e[:, 0]
        for t in range(1, steps):
            moved = log_sum(forward[:, t - 1, :, None] + params["moves"], 1) + e[:, t]
            forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
        total = log_sum(forward[:, -1], 1)
        for t in range(steps - 2, -1, -1):
            moved = log_sum(params["moves"] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], moved, 0)
        here = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        pair = forward[:, :-1, :, None] + params["moves"] + (e + backward)[:, 1:, None, :] - total[:, None, None, None]
        grads = {"weights": np.zeros_like(params["weights"]), "moves": (np.exp(pair) * real[:, 1:, None, None]).sum((0, 1)) - gold_moves, "first": (here - gold)[:, 0].sum(0)}
        wrong = np.repeat((here - gold)[real], ids.shape[2], 0)
        np.add.at(grads["weights"], ids[real].reshape(-1), wrong)
        for name, g in grads.items():
            g = g / n + decay * params[name]
            m, v = memory[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(**params)


def decode(model: Model, words: np.ndarray, lengths: np.ndarray, batch: int = 50_000) -> np.ndarray:
    """The most likely tags of chains laid end to end, by Viterbi over many chains at once; the longest go first."""
    out = np.zeros(len(words), np.int8)
    if not len(words):
        return out
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    # Batches of chains of similar length: the padded size stays near the number of words.
    sizes = np.cumsum(lengths[order])
    for part in np.split(order, np.unique(np.searchsorted(sizes, np.arange(batch, sizes[-1], batch)) + 1)):
        if len(part):
            size = lengths[part]
            own = np.cumsum(size) - size
            at = np.repeat(starts[part] - own, size) + np.arange(size.sum())
            tags = np.zeros(len(at), np.int8)
            _viterbi(model, emissions(model, feature_ids(words[at], size)), own, size, tags)
            out[at] = tags
    return out


def decode_long(model: Model, pieces: Iterable[np.ndarray]) -> np.ndarray:
    """The most likely tags of one chain whose words come a piece at a time. Scores are carried from piece to piece; what
    is kept of a word is a byte for each tag."""
    score, back = None, []
    previous, pending = None, None

    def forward(words: np.ndarray, before: np.ndarray | None, after: np.ndarray | None) -> None:
        nonlocal score
        around = [x for x in (before, words, after) if x is not None]
        e = emissions(model, feature_ids(np.concatenate(around), np.array([sum(map(len, around))])))
        e = e[0 if before is None else 1 :][: len(words)]
        for k, own in enumerate(e):
            if score is None:
                score = model.first + own
                continue
            moved = score[:, None] + model.moves
            came = moved.argmax(0).astype(np.int8)
            score = moved[came, np.arange(len(came))] + own
            back.append(came)

    for piece in pieces:
        if pending is not None:
            forward(pending, previous, piece[:1])
            previous = pending[-1:]
        pending = piece
    if pending is not None:
        forward(pending, previous, None)
    if score is None:
        return np.zeros(0, np.int8)
    out = np.zeros(len(back) + 1, np.int8)
    out[-1] = score.argmax()
    for k in range(len(back) - 1, -1, -1):
        out[k] = back[k][out[k + 1]]
    return out


def _viterbi(model: Model, e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
    steps = lengths[0]
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    score = model.first + e[starts]
    back = []
    for t in range(1, steps):
        a = active[t]
        moved = score[:a, :, None] + model.moves
        came = moved.argmax(1).astype(np.int8)
        score[:a] = np.take_along_axis(moved, came[:, None, :].astype(np.int64), 1)[:, 0] + e[starts[:a] + t]
        back.append(came)
    tag = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        a = active[t]
        out[starts[:a] + t] = tag[:a]
        tag[:a] = back[t - 1][np.arange(a), tag[:a]]
    out[starts] = tag
