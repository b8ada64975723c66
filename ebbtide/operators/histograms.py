"""Regression trees from counts per bin, on blocks of rows whose values were sorted into bins once.

A block is a dict of arrays, one for a partition of rows. The bins of several slots lie side by side in the bits of one
code, so a pass over the codes counts several slots at once. A tree grows level by level from the rows and the sum of the
target in every bin of every slot; of two children the smaller one is counted, the other is the rest of their parent.

Splits are MLlib's: the same candidates (up to 32 bins a slot, by equal numbers of rows), the same gain, the same draw of
slots for a node. The functions run in the tasks and, for rows of several partitions, partly on the driver; they need
numpy alone and go to the workers by value.
"""

from __future__ import annotations

import sys
from typing import Any

import numpy as np
from pyspark import cloudpickle

BINS = 32
# Slots whose bins fit together into so many bits share a code.
CODE_BITS = 12
# Different values of a slot, with their numbers of rows, that are told apart on the way to its bins.
POINTS = 2048

Points = list[tuple[np.ndarray, np.ndarray]]
Tree = dict[str, list]


# ---- bins


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values and their numbers of rows; beyond twice ``POINTS`` neighbours are put together."""
    values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([c for _, c in parts]), minlength=len(values))
    if len(values) > 2 * POINTS:
        upto = np.cumsum(counts)
        last = np.append(np.flatnonzero(np.diff(np.ceil(upto * (POINTS / upto[-1])))), len(values) - 1)
        values, counts = values[last], np.diff(upto[last], prepend=0.0)
    return values, counts


def points_of(x: np.ndarray) -> Points:
    """The points of every column of a batch."""
    return [joined([(column, np.ones(len(column)))]) for column in x.T]


def merged_points(left: Points, right: Points) -> Points:
    """Those of two sets of rows, of which one may be empty."""
    return [joined([a, b]) for a, b in zip(left, right)] if left and right else left or right


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Between all values where they are few, else where the number of rows below is nearest to a multiple of its share."""
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) < bins:
        return middles
    found, stride, upto = [], counts.sum() / bins, np.cumsum(counts)
    target = stride
    for i in range(len(middles)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            found.append(middles[i])
            target += stride
    return np.array(found)


def layout(cuts: list[np.ndarray]) -> dict[str, Any]:
    """Where the bins of every slot are: the code, the shift in it and the bits; slots with one bin have no code."""
    bits = [int(len(c)).bit_length() for c in cuts]
    used: list[int] = []
    code, shift = [-1] * len(cuts), [0] * len(cuts)
    for slot in sorted(range(len(cuts)), key=lambda s: -bits[s]):
        if bits[slot]:
            at = next((i for i, n in enumerate(used) if n + bits[slot] <= CODE_BITS), len(used))
            if at == len(used):
                used.append(0)
            code[slot], shift[slot] = at, used[at]
            used[at] += bits[slot]
    return {"cuts": cuts, "code": code, "shift": shift, "bits": bits, "used": used, "width": 1 << max(bits, default=0)}


def coded(x: np.ndarray, plan: dict[str, Any]) -> np.ndarray:
    """(row, code) of a batch. A value equal to a threshold lies below it."""
    codes = np.zeros((len(x), len(plan["used"])), np.uint16)
    for slot, cuts in enumerate(plan["cuts"]):
        if len(cuts):
            codes[:, plan["code"][slot]] |= (np.searchsorted(cuts, x[:, slot]) << plan["shift"][slot]).astype(np.uint16)
    return codes


# ---- trees


def leaf(tree: Tree) -> int:
    """Adds a node without rows and without a split; ``stats`` are its rows, the sum of the target and of its square."""
    for name, value in {"slot": -1, "bin": 0, "left": -1, "right": -1, "gain": -1.0, "value": 0.0, "stats": (0.0, 0.0, 0.0)}.items():
        tree.setdefault(name, []).append(value)
    return len(tree["slot"]) - 1


def best_splits(counts: np.ndarray, sums: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, slot): the highest gain of a split of the slot, and the bin it is made after. Gains that don't count are -inf."""
    if counts.shape[2] < 2:
        return np.full(counts.shape[:2], -np.inf), np.zeros(counts.shape[:2], int)
    n, total = counts.sum(axis=2, keepdims=True), sums.sum(axis=2, keepdims=True)
    below, inside = np.cumsum(counts, axis=2)[..., :-1], np.cumsum(sums, axis=2)[..., :-1]
    above, outside = n - below, total - inside
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (inside**2 / below + outside**2 / above - total**2 / n) / n
    gain = np.where((below >= max(1, least)) & (above >= max(1, least)), gain, -np.inf)
    at = gain.argmax(axis=2)
    return np.take_along_axis(gain, at[..., None], axis=2)[..., 0], at


def grow(rows, shape: dict[str, Any], seed: int) -> Tree:
    """One tree of at most ``depth`` levels, a node split by the best of ``drawn`` slots.

    ``rows.measure(tree, nodes, level)`` counts rows of the tree so far: rows and sums by (node, slot, bin) of ``nodes``,
    rows, sum and sum of squares by node of ``level``.
    """
    draw = np.random.default_rng([seed, 1])
    tree: Tree = {}
    level, counted, known = [leaf(tree)], [0], {}
    for step in range(shape["depth"] + 1):
        last = step == shape["depth"]
        counts, sums, stats = rows.measure(tree, [] if last else counted, level)
        for node, found in zip(level, stats.tolist()):
            tree["stats"][node], tree["value"][node] = tuple(found), found[1] / found[0] if found[0] else 0.0
        if last:
            break
        bins = {node: (counts[i], sums[i]) for i, node in enumerate(counted)}
        for node in level:
            if node not in bins:
                parent, sibling = known[node]
                bins[node] = tuple(whole - part for whole, part in zip(parent, bins[sibling]))
        gains, at = best_splits(*(np.stack(side) for side in zip(*(bins[node] for node in level))), shape["least"])
        following, counted, known = [], [], {}
        for i, node in enumerate(level):
            allowed = gains[i]
            if shape["drawn"] < shape["slots"]:
                chosen = np.zeros(shape["slots"], bool)
                chosen[draw.permutation(shape["slots"])[: shape["drawn"]]] = True
                allowed = np.where(chosen, allowed, -np.inf)
            slot = int(allowed.argmax())
            if not allowed[slot] > 0.0:
                continue
            cut, left, right = int(at[i, slot]), leaf(tree), leaf(tree)
            for name, value in {"slot": slot, "bin": cut, "left": left, "right": right, "gain": float(allowed[slot])}.items():
                tree[name][node] = value
            following += [left, right]
            smaller, larger = (left, right) if 2.0 * bins[node][0][slot, : cut + 1].sum() <= tree["stats"][node][0] else (right, left)
            counted.append(smaller)
            known[larger] = (bins[node], smaller)
        level = following
        if not level:
            break
    return tree


class Rows:
    """The rows of a block on their way through one tree: those it grows from, drawn by the seed, and the others."""

    def __init__(self, block: dict[str, Any], plan: dict[str, Any], first: bool, rate: float, seed: int) -> None:
        self.codes, self.plan, self.margin = block["codes"], plan, block["margin"]
        train, held = np.flatnonzero(block["train"]), np.flatnonzero(~block["train"])
        kept = np.random.default_rng([seed, 2, block["part"]]).random(len(train)) < rate if rate < 1.0 else np.ones(len(train), bool)
        self.inside, self.outside = {0: train[kept]}, {0: np.concatenate([train[~kept], held])}
        sign = 2.0 * block["label"] - 1.0
        self.target = sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * block["margin"]))

    def descend(self, tree: Tree) -> None:
        """Every row to the node it has come to."""
        plan = self.plan
        for rows in (self.inside, self.outside):
            todo = [node for node in rows if tree["slot"][node] >= 0]
            while todo:
                node = todo.pop()
                own, slot = rows.pop(node), tree["slot"][node]
                bins = (self.codes[plan["code"][slot]][own] >> plan["shift"][slot]) & ((1 << plan["bits"][slot]) - 1)
                below = bins <= tree["bin"][node]
                rows[tree["left"][node]], rows[tree["right"][node]] = own[below], own[~below]
                todo += [child for child in (tree["left"][node], tree["right"][node]) if tree["slot"][child] >= 0]

    def measure(self, tree: Tree, nodes: list[int], level: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.descend(tree)
        plan = self.plan
        shape = (len(nodes), len(plan["cuts"]), plan["width"])
        counts, sums = np.zeros(shape), np.zeros(shape)
        if nodes:
            own = [self.inside[node] for node in nodes]
            rows = np.concatenate(own)
            place, target = np.repeat(np.arange(len(nodes)), [len(o) for o in own]), self.target[rows]
            for code, used in enumerate(plan["used"]):
                at = self.codes[code][rows] + (place << used)
                slots = [slot for slot, c in enumerate(plan["code"]) if c == code]
                for out, weights in ((counts, None), (sums, target)):
                    found = np.bincount(at, weights, minlength=len(nodes) << used)
                    for slot in slots:
                        size = 1 << plan["bits"][slot]
                        out[:, slot, :size] = found.reshape(len(nodes), -1, size, 1 << plan["shift"][slot]).sum(axis=(1, 3))
        targets = [self.target[self.inside[node]] for node in level]
        return counts, sums, np.array([(len(t), t.sum(), np.dot(t, t)) for t in targets])

    def stepped(self, tree: Tree, weight: float) -> np.ndarray:
        """The margins with what the tree adds."""
        self.descend(tree)
        margin = self.margin.copy()
        for rows in (self.inside, self.outside):
            for node, own in rows.items():
                margin[own] += weight * tree["value"][node]
        return margin


def area(label: np.ndarray, score: np.ndarray) -> float | None:
    """The exact ROC-AUC of rows that are all here, a tied pair as one half."""
    order = np.argsort(score)
    ends = np.append(np.flatnonzero(np.diff(score[order])), len(order) - 1) if len(order) else np.array([], np.int64)
    up, all_rows = np.cumsum(label[order] > 0.5)[ends], ends + 1
    pos, neg = np.diff(up, prepend=0), np.diff(all_rows - up, prepend=0)
    pairs = 2 * int(pos.sum()) * int(neg.sum())
    return int((pos * (2 * np.cumsum(neg) - neg)).sum()) / pairs if pairs else None


def grown_here(block: dict[str, Any], plan: dict[str, Any], shape: dict[str, Any], todo: list[tuple[int, float, bool]]) -> dict[str, Any]:
    """Rounds of boosting where a block holds all rows: the block after them, with their trees and areas."""
    held, trees, areas = ~block["train"], [], []
    for seed, weight, first in todo:
        rows = Rows(block, plan, first, shape["rate"], seed)
        trees.append(grow(rows, shape, seed))
        block = {**block, "margin": rows.stepped(trees[-1], weight)}
        areas.append(area(block["label"][held], block["margin"][held]))
    return {**block, "trees": trees, "areas": areas}


def after(block: dict[str, Any], plan: dict[str, Any], shape: dict[str, Any], todo: tuple[int, float, bool], tree: Tree) -> dict[str, Any]:
    """A block of many after a round, and the margins of its validation rows after every round of the chunk so far."""
    seed, weight, first = todo
    margin = Rows(block, plan, first, shape["rate"], seed).stepped(tree, weight)
    return {**block, "margin": margin, "marks": [*block.get("marks", []), margin[~block["train"]]]}


def cleared(block: dict[str, Any]) -> dict[str, Any]:
    """A block without what the rounds of a chunk left in it."""
    return {name: block[name] for name in ("part", "codes", "train", "label", "margin")}


cloudpickle.register_pickle_by_value(sys.modules[__name__])
