"""Whether a file lies under a source path, which may be a glob."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable


def _plain(path: str) -> str:
    """A path without scheme and authority."""
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).strip("/")


def _pattern(glob: str) -> str:
    """The glob as a regular expression over whole names of folders and files."""
    out, i, depth = "", 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif c == "[" and "]" in glob[i + 2 :]:
            end = glob.index("]", i + 2)
            inside = glob[i + 1 : end]
            out += "[" + ("^" + inside[1:] if inside[0] in "!^" else inside) + "]"
            i = end
        elif c == "{":
            depth += 1
            out += "(?:"
        elif c == "}" and depth:
            depth -= 1
            out += ")"
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return out


def matcher(paths: Iterable[str]) -> Callable[[str], bool]:
    """Whether a file is named by one of the paths, or lies in a folder that is."""
    known = [re.compile(_pattern(_plain(p)) + "(?:/.*)?") for p in paths]
    return lambda file: any(p.fullmatch(_plain(file)) for p in known)
