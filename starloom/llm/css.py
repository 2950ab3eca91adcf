"""What style sheets say of visibility: selectors, their cascade, and a walk down a
tree that knows at each element which rules hold.

Selectors of tags, .classes and #ids, joined to compounds (``div.x#y``) and by descendant
and child combinators (``.a .b``, ``ul > li``) are matched; others never match. A selector
is matched step by step from its first compound on: the walk counts how many open
elements have met each step, so an element costs what its own tag, classes and id
are named in, whatever its depth.
"""

from __future__ import annotations

import re
from itertools import count

_CSS = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:[^"\\\n]|\\.)*"?|'(?:[^'\\\n]|\\.)*'?|[{};]|<!--|-->|[^"'{};/<-]+|.""", re.S)
_SHOWS = re.compile(r"\s*(display|visibility)\s*:\s*([a-z-]+)[^!]*(!\s*important)?\s*", re.I)
_MEDIA = re.compile(r"@media\b(.*)", re.I | re.S)
_COMPOUND = re.compile(r"(\*|[^\W\d][\w-]*)?((?:[.#][^\W\d-]?[\w-]+|[.#][^\W\d])*)")
_STEP = re.compile(r"\s*(>)\s*|\s+|([^\s>]+)")
ON_SCREEN = frozenset(["", "all", "screen", "only all", "only screen", "not print"])
_ORDER = count(1)
#: property -> (important, hides); hides is None where the parent's value holds
Declared = dict[str, tuple[bool, bool | None]]


def on_screen(media: str) -> bool:
    """Whether a media query holds on every screen."""
    return any(" ".join(q.lower().split()) in ON_SCREEN for q in media.split(","))


def declared(parts: list[str]) -> Declared:
    """Declarations -> what they say of display and visibility; the last holds."""
    out: Declared = {}
    for m in filter(None, map(_SHOWS.fullmatch, parts)):
        name, value = m[1].lower(), m[2].lower()
        if name == "display":
            hides = value == "none"
        else:
            hides = None if value in ("inherit", "unset", "revert", "revert-layer") else value in ("hidden", "collapse")
        if bool(m[3]) >= out.get(name, (False,))[0]:
            out[name] = bool(m[3]), hides
    return out


def parsed(selector: str) -> list[tuple[bool, str, str, frozenset[str]]] | None:
    """Steps of a selector: (child of the one before?, tag, id, classes); None if it has
    anything else in it."""
    steps, child, joined = [], False, True
    for m in _STEP.finditer(selector.strip()):
        if m[2] is None:
            child, joined = child or m[1] is not None, True
            continue
        c = _COMPOUND.fullmatch(m[2])
        if c is None or not joined:
            return None
        names = re.findall(r"[.#][\w-]+", c[2])
        ids = [n[1:] for n in names if n[0] == "#"]
        if len(set(ids)) > 1 or child and not steps:
            return None
        steps.append((child, "" if c[1] in (None, "*") else c[1].lower(), ids[0] if ids else "", frozenset(n[1:] for n in names if n[0] == ".")))
        child, joined = False, False
    return None if child else steps or None


class Styles:
    """The rules of a page's style elements that say something of visibility."""

    def __init__(self):
        self.known: dict[str, int | None] = {}
        self.steps: list[list] = []
        self.says: list[dict] = []
        #: what an element is named by -> (selector, step) that it may meet
        self.named: dict[str, list[tuple[int, int]]] = {}

    def add(self, selector: str, said: Declared) -> None:
        text = " ".join(selector.split())
        if text not in self.known:
            steps = parsed(text)
            self.known[text] = None if steps is None else len(self.steps)
            if steps is not None:
                for i, (_, tag, ident, classes) in enumerate(steps):
                    self.named.setdefault("#" + ident if ident else "." + min(classes) if classes else tag or "*", []).append((len(self.steps), i))
                self.steps.append(steps)
                self.says.append({})
        n = self.known[text]
        if n is None:
            return
        weight = (0, sum(bool(s[2]) for s in self.steps[n]), sum(len(s[3]) for s in self.steps[n]), sum(bool(s[1]) for s in self.steps[n]))
        for name, (important, hides) in said.items():
            new = (important, weight, next(_ORDER), hides)
            self.says[n][name] = max(self.says[n].get(name, new), new)

    def read(self, css: str) -> None:
        """Add a style sheet. Blocks of at-rules don't count, save @media that holds on
        every screen; nor do rules nested in rules."""
        now: list[str] = []
        stack: list[tuple[list[str] | None, bool, list[str]]] = []  # selectors (None: at-rule), whether it counts, declarations

        def end() -> None:
            selectors, counts, parts = stack.pop()
            if selectors and counts and (said := declared([*parts, "".join(now)])):
                for s in selectors:
                    self.add(s, said)

        for m in _CSS.finditer(css):
            x = m[0]
            if x == "{":
                head, counts = "".join(now).strip(), not stack or stack[-1][0] is None and stack[-1][1]
                if head.startswith("@"):
                    media = _MEDIA.fullmatch(head)
                    stack.append((None, counts and media is not None and on_screen(media[1]), []))
                else:
                    stack.append((head.split(","), counts, []))
                now.clear()
            elif x == "}":
                if stack:
                    end()
                now.clear()
            elif x == ";":
                if stack:
                    stack[-1][2].append("".join(now))
                now.clear()
            elif not x.startswith("/*") and x not in ("<!--", "-->"):
                now.append(x)
        while stack:  # the end of the sheet ends its blocks
            end()
            now.clear()


class Walk:
    """A walk down a tree: ``at`` says what holds for an element whose parent is the
    innermost one that was entered."""

    def __init__(self, styles: Styles):
        self.styles = styles
        self.open: dict[tuple[int, int], int] = {}
        self.path: list[list[tuple[int, int]]] = [[]]

    def at(self, tag: str, attrs: dict[str, str]) -> tuple[dict[str, bool | None], list]:
        """What the cascade says of display and visibility, and the steps met (for ``enter``)."""
        s, met, said = self.styles, [], []
        if s.steps:
            ident, classes = attrs.get("id", ""), set(attrs.get("class", "").split())
            parent = self.path[-1]
            for name in ("*", tag, "#" + ident, *("." + c for c in classes)):
                for n, i in s.named.get(name, ()):
                    child, t, d, c = s.steps[n][i]
                    if t not in ("", tag) or d not in ("", ident) or not c <= classes:
                        continue
                    if i and not ((n, i - 1) in parent if child else self.open.get((n, i - 1))):
                        continue
                    met.append((n, i))
                    if i == len(s.steps[n]) - 1:
                        said.append(s.says[n])
        if "style" in attrs:  # weighs more than any selector
            said.append({k: (important, (1,), 0, hides) for k, (important, hides) in declared(attrs["style"].split(";")).items()})
        return {k: max((x[k] for x in said if k in x), key=lambda v: v[:3])[3] for k in {k for x in said for k in x}}, met

    def enter(self, met: list[tuple[int, int]]) -> None:
        self.path.append(met)
        for x in met:
            self.open[x] = self.open.get(x, 0) + 1

    def leave(self) -> None:
        for x in self.path.pop():
            self.open[x] -= 1
