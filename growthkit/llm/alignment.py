"""Cheapest repair of a sequence of turns by Wagner-Fischer alignment with strings of an alternating grammar.

Turns are letters: s, u, a or x (any other role), a capital for a truncated text, d for a turn that must go. What
is left of them after all edits has the form (s?(ua)+)?. Keeping costs 0, a new role 2, deleting 3, inserting 2, and 1
more for a truncated turn that stays.

A sequence may be a part of a longer one. It then begins in one of the states START, SYSTEM, USER and
ASSISTANT (nothing or that role came last) and `ends` has the cost of what follows each state at its end.
"""

from __future__ import annotations

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 40
#: Cost of finishing a whole sequence in each state, and the inserts that do it.
CLOSE, CLOSING = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def after(state: int, edit: str, code: str) -> int:
    """The state behind an edit; `code` is the turn that a K keeps."""
    if edit == "D":
        return state
    if edit == "K":
        return _STATE[code.lower()]
    return ASSISTANT if state == USER else USER


def _incumbent(codes: str, state: int, ends: tuple) -> int:
    """The cost of a plain repair from left to right: keep what fits, give all else the role that is due."""
    cost = 0
    for code in codes:
        if code == "d":
            cost += DELETE
            continue
        fits = after(state, "R", code) == _STATE.get(code.lower())
        if not fits and not (state == START and code in "sS"):
            cost += REROLE
            state = after(state, "R", code)
        else:
            state = _STATE[code.lower()]
        cost += TRUNCATED * code.isupper()
    return cost + ends[state]


class _Table:
    """Costs of aligning the turns from i on with the last r letters of a target that ends in `last`.

    Letters alternate, so targets of all lengths share a table. Row i holds the diagonals r - (n - i) of
    Ukkonen's band: off it, deletes or inserts alone cost more than `most`.
    """

    def __init__(self, codes: str, last: str, most: int) -> None:
        n = len(codes)
        self.n, self.low = n, most // DELETE
        width = self.low + most // INSERT + 1
        diagonal = np.arange(width) - self.low
        self.last = last
        self.cost = np.full((n + 1, width + 1), FAR, np.int64)
        self.cost[n, self.low] = 0
        steps = INSERT * np.arange(width)
        match = {c: np.array([self._match(c, t) for t in "au"]) for c in set(codes)}
        for i in range(n - 1, -1, -1):
            left = diagonal + n - i
            is_u = ((left & 1) == 0) == (last == "a")
            best = np.where(left > 0, self.cost[i + 1, :-1] + match[codes[i]][is_u.astype(np.int8)], FAR)
            best = np.minimum(best, np.where(left >= 0, self.cost[i + 1, 1:] + DELETE, FAR))
            self.cost[i, :-1] = np.minimum(np.minimum.accumulate(best - steps) + steps, FAR)
        self.codes = codes

    @staticmethod
    def _match(code: str, target: str) -> int:
        if code == "d":
            return FAR
        return (KEEP if code.lower() == target else REROLE) + TRUNCATED * code.isupper()

    def at(self, i: int, r: int) -> int:
        place = r - (self.n - i) + self.low
        return int(self.cost[i, place]) if r >= 0 and 0 <= place < self.cost.shape[1] else FAR

    def audit(self, i: int, r: int) -> str:
        """The ASCII-least cheapest edits of the turns from i on into the last r letters."""
        out = []
        while i < self.n:
            here = self.at(i, r)
            target = "a" if (r & 1) == (self.last == "a") else "u"
            if self.at(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r and self.at(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.codes[i].lower() == target else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _lengths(state: int, last: str) -> int:
    """The parity of targets from `state` to a last letter, without s."""
    return (state == USER) == (last == "a")


def _targets(codes: str, state: int, ends: tuple, most: int):
    """(cost, state at the end, audit as a function) of the best alignment with each feasible target."""
    n = len(codes)
    yield DELETE * n + ends[state], state, lambda: "D" * n
    # s can only be kept, after deletes; the last of equally cheap ones gives the least audit
    system = [(DELETE * i + TRUNCATED * codes[i].isupper(), i) for i in range(n) if state == START and codes[i] in "sS"]
    if system:
        extra, i = min((c - DELETE * i, -i) for c, i in system)
        yield DELETE * (n - 1) + extra + ends[SYSTEM], SYSTEM, lambda: "D" * -i + "K" + "D" * (n + i - 1)
    for last in "ua":
        to = _STATE[last]
        if ends[to] >= FAR:
            continue
        table = _Table(codes, last, most)
        odd = _lengths(state, last)
        for r in range(max(0, n - table.low), n + most // INSERT + 1):
            if r % 2 == odd and r:
                yield table.at(0, r) + ends[to], to, lambda table=table, r=r: table.audit(0, r)
            if system and r > 1 and r % 2 != odd:
                cost, at = min((c + table.at(i + 1, r - 1), -i) for c, i in system)
                yield cost + ends[to], to, lambda table=table, r=r, at=at: "D" * -at + "K" + table.audit(1 - at, r - 1)


def best(codes: str, state: int = START, ends: tuple = CLOSE) -> tuple[int, str, int]:
    """(cost with `ends`, ASCII-least audit of the cheapest repairs, state at the end).

    Inserts stand before a turn; what `ends` accounts for is no part of the audit.
    """
    found = list(_targets(codes, state, ends, _incumbent(codes, state, ends)))
    least = min(cost for cost, _, _ in found)
    audit, to = min((audit(), to) for cost, to, audit in found if cost == least)
    return least, audit, to


def costs(codes: str) -> list[list[int]]:
    """The least cost of the turns from each state to each state, FAR where there is no way."""
    out = [[FAR] * 4 for _ in range(4)]
    free = (0, 0, 0, 0)
    for state in range(4):
        # another last letter takes one insert and a new role more at most
        for cost, to, _ in _targets(codes, state, free, _incumbent(codes, state, free) + 3 * (REROLE + INSERT)):
            out[state][to] = min(out[state][to], cost)
    return out
