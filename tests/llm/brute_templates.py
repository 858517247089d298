"""Contaminated pairs by the definition, token by token, without hashes, bitmaps or joins."""

import re

from tidemark.llm.decontaminate import ENOUGH, LITERALS, UNITS, WHOLE, WINDOW

SPACE = "\x20\t\n\x0b\x0c\r"
STOPS = '!.:;?")'


def ink(c):
    return (c.isascii() and c.isalnum()) or ord(c) >= 128


def fold(word):
    return "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in word)


def tokens(text):
    """[(own, kind, able)]: kind 0 literal, 1 number, 2 name, 3 unit."""
    out, last = [], None
    for raw in re.split(f"[{SPACE}]+", text or ""):
        if not raw:
            continue
        opens = last is None or last[-1] in STOPS
        last = raw
        places = [i for i, c in enumerate(raw) if ink(c)]
        if not places:
            continue
        word = raw[places[0] : places[-1] + 1]
        own = fold(word)
        marks = [c for c in word if ink(c)]
        number = all(c.isascii() and c.isdigit() for c in marks)
        ups = sum(a != b for a, b in zip(word, own))
        able = word[0] != own[0] and ups == 1 and len(word) > 1 and not number
        unit = bool(out) and own in UNITS and out[-1][1] == 1 and not number
        kind = 1 if number else 3 if unit else 2 if able and not opens else 0
        out.append((own, kind, able))
    return out


def window(toks, kinds, at, size):
    """(template, fillers) of a window whose tokens have these kinds."""
    own = [t[0] for t in toks[at : at + size]]
    ks = kinds[at : at + size]
    return tuple((k, "" if k else o) for o, k in zip(own, ks)), [o for o, k in zip(own, ks) if k]


def item_windows(toks):
    """[(at, size, template, fillers, fillers that must be the same, exact, counts as a template, how many must be met)]"""
    kinds = [k for _, k, _ in toks]
    plain = [0 if k == 2 else k for k in kinds]
    c, out = len(toks), []
    lit = lambda ks, at, size: sum(not k for k in ks[at : at + size])

    def least(size):
        return size if size < LITERALS else WHOLE if size < WINDOW else LITERALS

    def templates(at, size, exact, need=1):
        t, f = window(toks, kinds, at, size)
        out.append((at, size, t, f, [], exact, True, need))
        if at == 0 and toks[0][2] and not kinds[0]:
            named = [2, *kinds[1:]]
            t, f = window(toks, named, at, size)
            out.append((at, size, t, f, [toks[0][0]] if lit(named, at, size) < least(size) else [], exact, True, need))

    def uncased(at, size, exact, template, need=1):
        n, m = lit(kinds, at, size), lit(plain, at, size)
        if n < m < size and m >= (least(size) if size <= WINDOW else 0):
            t, f = window(toks, plain, at, size)
            out.append((at, size, t, f, [toks[i][0] for i in range(at, at + size) if kinds[i] == 2], exact, template, need))

    size, some = min(c, WINDOW), False
    for at in range(c - size + 1) if c else ():
        rich = lit(kinds, at, size) >= least(size)
        some |= rich
        if rich:
            templates(at, size, True)
        uncased(at, size, True, rich)
        if lit(kinds, at, size) < size:
            out.append((at, size, window(toks, [0] * c, at, size)[0], [], [toks[i][0] for i in range(at, at + size) if kinds[i]], True, rich, 1))
    if not some and c >= WINDOW and lit(kinds, 0, c) >= WHOLE:
        size = 2 * WINDOW
        while size <= c and not some:
            for at in range(c - size + 1):
                if lit(kinds, at, size) >= LITERALS:
                    some = True
                    templates(at, size, False)
                    uncased(at, size, False, True)
            size *= 2
        if not some:
            size = WINDOW
            while 2 * size <= c:
                size *= 2
            ends = sorted({0, c - size})
            for at in ends:
                templates(at, size, False, len(ends))
    return out


def contaminated(doc, item):
    d, rows = tokens(doc), item_windows(tokens(item))
    kinds = [k for _, k, _ in d]
    n = [len({r[0] for r in rows if r[5 + i]}) for i in (0, 1)]
    shifts = {}
    for size in {r[1] for r in rows}:
        for at in range(len(d) - size + 1):
            seen = [window(d, kinds, at, size)]
            if seen[0][1]:
                seen.append((window(d, [0] * len(d), at, size)[0], None))
            for t, fill in seen:
                for r in rows:
                    if r[1] == size and r[2] == t and (fill is not None or not r[3]):
                        shifts.setdefault(at - r[0], []).append((r, [*zip(r[3], fill or []), *zip(r[4], r[4])]))
    met = [set(), set()]
    for hits in shifts.values():
        pairs = {p for _, ps in hits for p in ps}
        if len(pairs) != len({a for a, _ in pairs}):
            continue
        met[0] |= {r[0] for r, _ in hits if r[5]}
        template = {r[0] for r, _ in hits if r[6]}
        if len(template) >= max(r[7] for r, _ in hits):
            met[1] |= template
    return any(m and (2 * len(m) >= k or len(m) >= ENOUGH) for m, k in zip(met, n))
