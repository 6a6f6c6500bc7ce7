"""What a C# source declares: a tokeniser that knows strings and comments, and the declarations among its tokens."""

from __future__ import annotations

import re

#: comments, directives, verbatim, raw and plain strings, characters, names, numbers, marks; what is left unclosed ends with its line or the text
_TOKEN = re.compile(
    r"""(?P<skip>\s+|//[^\n]*|/\*.*?(?:\*/|\Z)|\#[^\n]*)
      | (?P<text>\$*\"{3,}.*?(?:\"{3,}|\Z)|(?:\$@|@\$|@)"(?:[^"]|"")*(?:"|\Z)|\$?"(?:[^"\\\n]|\\.)*(?:"|(?=\n)|\Z)|'(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z))
      | (?P<name>@?[^\W\d]\w*)|(?P<number>\d[\w.]*)|(?P<mark>=>|::|.)""",
    re.X | re.S | re.M,
)
_KINDS = ("class", "struct", "interface", "enum", "record")
_CLOSED = {"(": ")", "[": "]", "{": "}"}


def tokens(text: str) -> list[tuple[str, str]]:
    """(kind, token) without spaces, comments and directives; strings and characters are of kind text."""
    return [(m.lastgroup, m.group()) for m in _TOKEN.finditer(text) if m.lastgroup != "skip"]


def _after(toks: list, i: int) -> int:
    """The place behind the bracket that closes the one at i."""
    depth = 0
    while i < len(toks):
        kind, t = toks[i]
        if kind == "mark":
            depth += (t in "([{") - (t in ")]}")
        i += 1
        if depth <= 0:
            break
    return i


def _plain(toks: list) -> list:
    """Without what is between angle brackets: generic arguments are no names of their own."""
    out, depth = [], 0
    for t in toks:
        if t == ("mark", "<"):
            depth += 1
        elif t == ("mark", ">"):
            depth = max(0, depth - 1)
        elif not depth:
            out.append(t)
    return out


def _written(toks: list) -> str:
    """Tokens as text: a space between names, none before marks."""
    out = ""
    for kind, t in toks:
        out += (" " if out and (kind != "mark" and (out[-1].isalnum() or out[-1] in "_,>]?")) else "") + t
    return out.replace(",", ", ").replace(",  ", ", ")


def _head(toks: list, i: int) -> tuple[list, int, str]:
    """A declaration's head from i on, attributes left out: its tokens, where it ends, and the mark that ends it."""
    head: list = []
    while i < len(toks):
        kind, t = toks[i]
        if kind == "mark":
            if t == "[" and not head:
                i = _after(toks, i)
                continue
            if t in ("{", "}", ";", "=>", "="):
                return head, i, t
            if t in "([":
                end = _after(toks, i)
                head += toks[i:end]
                i = end
                continue
        head.append(toks[i])
        i += 1
    return head, i, ""


def _type(head: list) -> tuple[str, str, list[str]] | None:
    """(kind, name, bases) if a head declares a type."""
    flat = _plain(head)
    for i, (kind, t) in enumerate(flat[:-1]):
        if kind == "name" and t in _KINDS and flat[i + 1][0] == "name":
            at = i + 2 if t == "record" and flat[i + 1][1] in ("class", "struct") and i + 2 < len(flat) else i + 1
            name, rest = flat[at][1], flat[at + 1 :]
            if rest and rest[0] == ("mark", "("):
                rest = rest[_after(rest, 0) :]
            bases: list[str] = []
            if rest and rest[0] == ("mark", ":"):
                part = ""
                for k, x in [*rest[1:], ("mark", ",")]:
                    if (k, x) == ("name", "where"):
                        break
                    if (k, x) == ("mark", ","):
                        bases.append(part)
                        part = ""
                    elif (k, x) == ("mark", "("):
                        bases.append(part)  # what a record hands its base
                        part = "("
                    elif not part.startswith("("):
                        part += x
                if part and not part.startswith("("):
                    bases.append(part)
            return t, name, [b for b in bases if b and b != "("]
        if (kind, t) == ("mark", "("):
            return None
    return None


def _member(head: list, owner: str, end: str) -> tuple[str, str, str] | None:
    """(kind, name, parameters) of a head in a type's body."""
    opened = next((i for i, t in enumerate(head) if t == ("mark", "(")), None)
    if opened is not None:
        flat = _plain(head[:opened])
        if flat and flat[-1][0] == "name" and ("mark", "~") not in flat:
            name = flat[-1][1]
            return "constructor" if name == owner else "method", name, _written(head[opened + 1 : _after(head, opened) - 1])
        return None
    flat = [t for t in _plain(head) if t[0] == "name"]
    if len(flat) < 2:
        return None
    return "field" if end in ";=" else "property", flat[-1][1], ""


def _generic(toks: list, i: int) -> int:
    """The place behind generic arguments that begin at i; i where there are none."""
    depth, j = 0, i
    while j < len(toks) and (toks[j][0] == "name" or toks[j][1] in "<>,.?[]"):
        depth += (toks[j] == ("mark", "<")) - (toks[j] == ("mark", ">"))
        j += 1
        if depth <= 0:
            return j if j > i + 1 and toks[j : j + 1] and toks[j][1] in "({[.;,)" else i
    return i


def _further(toks: list, i: int) -> tuple[list[str], int]:
    """Names that a field's declaration goes on with after the first value, and the place of its end."""
    names = []
    while i < len(toks) and toks[i] != ("mark", ";"):
        if toks[i] == ("mark", ",") and toks[i + 1 : i + 2] and toks[i + 1][0] == "name":
            names.append(toks[i + 1][1])
            i += 2
        elif toks[i][0] == "mark" and toks[i][1] in _CLOSED:
            i = _after(toks, i)
        elif toks[i] == ("mark", "<"):
            i = max(i + 1, _generic(toks, i))
        else:
            i += 1
    return names, i


def declarations(text: str | None) -> list[tuple]:
    """(namespace, type, kind, bases, member, member kind, parameters): a row a type (member null) and a row a member.

    Types within types are named Outer.Inner. Bodies of members are skipped, so that what stands in
    strings, comments and code declares nothing. What isn't closed ends with the text; null declares nothing.
    """
    toks, out, i = tokens(text or ""), [], 0
    stack: list[tuple[str, str]] = []  # ("namespace" or a type's kind, full name)
    space = ""
    while i < len(toks):
        kind, owner = stack[-1] if stack else ("", "")
        if kind == "enum":
            name = toks[i][1] if toks[i][0] == "name" else None
            if toks[i] == ("mark", "["):
                i = _after(toks, i)
                continue
            if toks[i] == ("mark", "}"):
                stack.pop()
                i += 1
                continue
            if name:
                out.append((space_of(stack, space), owner, "enum", [], name, "value", ""))
            while i < len(toks) and toks[i] not in (("mark", ","), ("mark", "}")):
                i = _after(toks, i) if toks[i][0] == "mark" and toks[i][1] in _CLOSED else i + 1
            i += toks[i : i + 1] == [("mark", ",")]
            continue
        head, i, end = _head(toks, i)
        if end == "}":
            if stack:
                stack.pop()
            i += 1
            continue
        named = _type(head)
        if ("name", "namespace") in head[:1]:
            path = "".join(t for _, t in head[1:])
            if end == "{":
                stack.append(("namespace", path))
            else:
                space = path
            i += 1
        elif named and end in ("{", ";"):
            inner = f"{owner}.{named[1]}" if kind in _KINDS else named[1]
            out.append((space_of(stack, space), inner, named[0], named[2], None, None, None))
            if end == "{":
                stack.append((named[0], inner))
            i += 1
        elif kind in _KINDS:
            found = _member(head, owner.rsplit(".", 1)[-1], end)
            if found:
                names = [found[1]]
                if found[0] == "field":
                    flat = _plain(head)
                    names = [t for i, (k, t) in enumerate(flat) if k == "name" and flat[i + 1 : i + 2] == [("mark", ",")]] + names
                    if end == "=":
                        more, i = _further(toks, i)
                        names += more
                out += [(space_of(stack, space), owner, kind, [], n, found[0], found[2]) for n in names]
            if end == "{":
                i = _after(toks, i)
                if toks[i : i + 1] == [("mark", "=")]:  # a property's first value
                    end = "="
            if end in ("=", "=>"):
                while i < len(toks) and toks[i] != ("mark", ";"):
                    i = _after(toks, i) if toks[i][0] == "mark" and toks[i][1] in _CLOSED else i + 1
            i += end != "{"
        else:
            i = _after(toks, i) if end == "{" else i + 1
    return out


def space_of(stack: list[tuple[str, str]], space: str) -> str:
    return ".".join([space] * bool(space) + [n for k, n in stack if k == "namespace"])
