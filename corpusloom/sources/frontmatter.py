"""Markdown records: YAML frontmatter between ``---`` lines, then the body. PyYAML where it is installed, else a subset of its own."""

from __future__ import annotations

import json
import re

try:
    import yaml
except ImportError:  # optional
    yaml = None

_HEAD = re.compile(r"\A---\n(.*?)^---\n\n?", re.S | re.M)


def split(text: str) -> tuple[str, str]:
    """(frontmatter, body without the newline that ends the file); no frontmatter is the empty one."""
    m = _HEAD.match(text)
    if not m:
        return "", text
    body = text[m.end() :]
    return m[1], body[:-1] if body.endswith("\n") else body


def _scalar(lines: list[str]) -> str | None:
    """A scalar over several lines: folded, unquoted."""
    text = ""
    for i, line in enumerate(lines):
        line = line.strip()
        text += line if not i else "\n" if not line else line if text.endswith("\n") else " " + line
    text = text.rstrip("\n")
    if text[:1] == "'":
        return text[1:-1].replace("''", "'")
    if text[:1] == '"':
        return json.loads('"' + text[1:-1].replace("\n", "\\n") + '"')
    return None if text in ("null", "~", "") else text


def parse_plain(head: str) -> dict[str, str | list[str] | None]:
    """Without PyYAML: keys at the margin with scalars (plain, quoted, folded over lines) or lists of scalars."""
    out: dict[str, str | list[str] | None] = {}
    key, held = None, []

    def close():
        if key is None:
            return
        items = [x for x in held if x.strip()]
        if len(items) == 1 and items[0].strip() == "[]":
            out[key] = []
        elif items and all(x.startswith("- ") for x in items[:1]):
            out[key] = []
            item: list[str] = []
            for x in [*held, None]:
                if x is None or x.startswith("- "):
                    if item:
                        out[key].append(_scalar(item))
                    item = [x[2:]] if x is not None else []
                else:
                    item.append(x)
        else:
            out[key] = _scalar(held)

    for line in head.split("\n"):
        m = re.match(r"([A-Za-z_][\w-]*):(?: (.*))?$", line)
        if m and (not held or not _open(held)):
            close()
            key, held = m[1], [m[2]] if m[2] else []
        else:
            held.append(line)
    close()
    return out


def _open(held: list[str]) -> bool:
    """Whether a quoted scalar is still open."""
    first = held[0].lstrip()
    first = first[2:] if first.startswith("- ") else first
    text = "\n".join([first, *held[1:]])
    if first[:1] == "'":
        return len(re.findall("'", text)) % 2 == 1
    if first[:1] == '"':
        return len(re.findall(r'(?<!\\)(?:\\\\)*"', text)) % 2 == 1
    return False


def parse(head: str) -> dict[str, str | list[str] | None]:
    """Fields as text or lists of text; null is None. Labels like 091 stay text."""
    if yaml is None:
        return parse_plain(head)
    loaded = yaml.load(head, Loader=yaml.BaseLoader) or {}
    one = lambda v: None if v in ("null", "~", "") else v
    quoted = set(re.findall(r"^([A-Za-z_][\w-]*): (?:''|\"\"|'null'|\"null\")$", head, re.M))
    return {k: v if isinstance(v, list) or k in quoted else one(v) for k, v in loaded.items()}


def render(fields: list[str], row: dict, body: str) -> str:
    """A record's file: its fields in order, then the body."""
    kept = {f: row.get(f) for f in fields}
    if yaml is not None:
        head = yaml.safe_dump(kept, sort_keys=False, allow_unicode=True, default_flow_style=False)
    else:
        said = lambda v: "null" if v is None else json.dumps(v, ensure_ascii=False)
        head = "".join(f"{k}: {said(v)}\n" if not isinstance(v, list) or not v else f"{k}:\n" + "".join(f"- {said(x)}\n" for x in v) for k, v in kept.items())
    return f"---\n{head}---\n\n{body}\n"
