"""Named-group line patterns as Spark column expressions.

Spark's regex functions take numbered groups only, so `(?P<name>...)` is written as
a plain group and its number remembered.
"""

import re
from dataclasses import dataclass

from logweir.functions.text import literal

# White space also includes the four separator controls, as in the patterns' own dialect.
_SPACE = r"\s\x1c-\x1f"
# U: Unicode classes; d: only \n ends a line for `.`.
_FLAGS = "(?Ud)"
# A Unicode noncharacter; lines that do contain it take the slower branch.
_SEPARATOR = "﷐"

@dataclass(frozen=True)
class LinePattern:
    regex: str  # numbered groups, anchored at the start
    groups: dict  # name -> group number
    count: int  # number of capturing groups
    optional: frozenset  # group numbers that a match may leave out

    @property
    def names(self):
        return list(self.groups)

    def values(self, line: str) -> str:
        """SQL text of the array of all groups (index = number - 1) and one empty text, of
        that size only where the line matches.

        One regex run per line: the match is rewritten to separated groups and split.
        """
        numbers = range(1, self.count + 1)
        regex, mark = literal(self.regex), literal(_SEPARATOR)
        joined = literal("".join(f"${i}{_SEPARATOR}" for i in numbers))
        groups = ", ".join(f"regexp_extract({line}, {regex}, {i})" for i in numbers)
        slow = f"IF({line} RLIKE {regex}, array({groups}, ''), NULL)"
        whole = literal(f"{self.regex}(?s:.*)")
        fast = f"split(regexp_replace({line}, {whole}, {joined}), {mark})"
        return f"IF(contains({line}, {mark}), {slow}, {fast})"

    def value_sql(self, values: str, name: str) -> str:
        """SQL text of one group of the array `values`; an optional group left out is null."""
        number = self.groups[name]
        value = f"{values}[{number - 1}]"
        return f"nullif({value}, '')" if number in self.optional else value


def line_pattern(text: str) -> LinePattern:
    """Rewrite named groups to numbered ones and note which groups a match may leave out."""
    checked = re.compile(text)
    if not checked.groups:
        raise ValueError("a line pattern needs at least one group")
    out, optional, opened = [], set(), 0
    frames = [{"own": None, "inside": [], "either": False}]
    at, in_class = 0, False
    while at < len(text):
        char, rest = text[at], text[at:]
        step = 1
        if char == "\\":
            char, step = rest[:2], 2
            if char == r"\s":
                char = _SPACE if in_class else f"[{_SPACE}]"
            elif char == r"\S" and not in_class:
                char = f"[^{_SPACE}]"
            elif char == r"\Z" and not in_class:
                char = r"\z"
        elif in_class:
            if char == "]":
                in_class = False
            elif char in "[&":
                char = "\\" + char
        elif char == "[":
            in_class = True
            char = re.match(r"\[\^?\]?", rest).group()
            step = len(char)
            char = char.replace("]", r"\]")
        elif back := re.match(r"\(\?P=(\w+)\)", rest):
            char, step = f"(?:\\{checked.groupindex[back[1]]})", back.end()
        elif char == "(":
            named = re.match(r"\(\?P<\w+>", rest)
            captures = named or not rest.startswith("(?")
            opened += bool(captures)
            frames.append({"own": opened if captures else None, "inside": [], "either": False})
            step = named.end() if named else 1
        elif char == ")":
            frame = frames.pop()
            if frame["either"]:
                optional.update(frame["inside"])
            held = frame["inside"] + ([frame["own"]] if frame["own"] else [])
            if re.match(r"\)([?*]|\{0?,)", rest):
                optional.update(held)
            frames[-1]["inside"].extend(held)
        elif char == "|":
            frames[-1]["either"] = True
        out.append(char)
        at += step
    if frames[0]["either"]:
        optional.update(frames[0]["inside"])
    regex = _FLAGS + "^(?:" + "".join(out) + ")"
    return LinePattern(regex, dict(checked.groupindex), checked.groups, frozenset(optional))
