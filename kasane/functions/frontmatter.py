"""Nested front matter: indented YAML read into JSON (and from there into VARIANT), and written back.

Read are block mappings and lists, plain, quoted, literal and folded values over any number of lines, lists and mappings in brackets, and
comments. Anchors, tags and several documents in one block are not; a block that cannot be read is null. Plain words mean what YAML 1.1 says of
null, true and false (yes, no, on and off too) and of decimal numbers; dates stay strings.
"""

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kasane.functions import links as L

_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|(?![-?](?:\s|$))[^\s"'#&*!|>%@`{}\[\],][^\n]*?)\s*:(?:\s+(.*)|)$""")
_BLOCK = re.compile(r"([|>])([+-]?)\s*(?:#.*)?$")
_DOUBLE, _SINGLE = re.compile(r'"((?:[^"\\]|\\.)*)"', re.S), re.compile(r"'((?:[^']|'')*)'", re.S)
_INT, _FLOAT = re.compile(r"[-+]?(?:0|[1-9][0-9_]*)$"), re.compile(r"[-+]?(?:[0-9][0-9_]*)\.[0-9]*(?:[eE][-+][0-9]+)?$")
# The words of YAML 1.1.
_WORDS = {"": None, "~": None, "null": None, "true": True, "yes": True, "on": True, "false": False, "no": False, "off": False}
_ESCAPES = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b", " ": " ", '"': '"', "/": "/", "\\": "\\", "N": "\x85", "_": "\xa0", "L": " ", "P": " "}


def _plain(text: str):
    """A plain word as what it means."""
    if text.lower() in _WORDS and text in (text.lower(), text.upper(), text.capitalize()):
        return _WORDS[text.lower()]
    if _INT.match(text):
        return int(text.replace("_", ""))
    return float(text.replace("_", "")) if _FLOAT.match(text) else text


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1][1:], 16))
        if m[0][1] not in _ESCAPES:
            raise ValueError(f"no such escape: {m[0]}")
        return _ESCAPES[m[0][1]]

    found = re.sub(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8})|\\.", one, text, flags=re.S)
    return found.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _folded(text: str) -> str:
    """Lines of a value as one: a line end is a blank, empty lines are line ends."""
    return re.sub(r"[ \t]*\n[ \t]*((?:\n[ \t]*)*)", lambda m: "\n" * m[1].count("\n") or " ", text)


class _Lines:
    """The lines of a block, read from the top."""

    def __init__(self, text: str) -> None:
        self.lines, self.at = text.split("\n"), 0

    def next(self) -> tuple[int, str] | None:
        """(indent, content) of the next line that is not blank and no comment; it is not taken yet."""
        while self.at < len(self.lines):
            line = self.lines[self.at].rstrip("\r \t")
            content = line.lstrip(" ")
            if content and not content.startswith("#"):
                if content[0] == "\t":
                    raise ValueError("a tab as indent")
                return len(line) - len(content), content
            self.at += 1
        return None

    def block(self, least: int):
        """The value that begins on the next line, if that is indented by ``least`` or more."""
        now = self.next()
        if now is None or now[0] < least:
            return None
        indent, content = now
        if content == "-" or content.startswith("- "):
            return self.list(indent)
        if _KEY.match(content):
            return self.mapping(indent)
        self.at += 1
        return self.value(content, least)

    def list(self, indent: int) -> list:
        out = []
        while (now := self.next()) and now[0] == indent and (now[1] == "-" or now[1].startswith("- ")):
            inner = now[1][1:].lstrip(" ")
            if not inner or inner.startswith("#"):
                self.at += 1
                out.append(self.block(indent + 1))
            elif inner == "-" or inner.startswith("- ") or _KEY.match(inner) and not inner.startswith(("{", "[")):
                deeper = indent + len(now[1]) - len(inner)
                self.lines[self.at] = " " * deeper + inner  # what follows the dash is a block of its own
                out.append(self.block(deeper))
            else:
                self.at += 1
                out.append(self.value(inner, indent + 1))
        return self._ended(out, indent)

    def mapping(self, indent: int) -> dict:
        out = {}
        while (now := self.next()) and now[0] == indent and (m := _KEY.match(now[1])) and not now[1].startswith("- "):
            self.at += 1
            key, rest = m[1], (m[2] or "").strip()
            name = _unescaped(key[1:-1]) if key[0] == '"' else key[1:-1].replace("''", "'") if key[0] == "'" else key
            if rest and not rest.startswith("#"):
                out[name] = self.value(rest, indent + 1)
            else:
                after = self.next()
                lists = after and after[0] == indent and (after[1] == "-" or after[1].startswith("- "))
                out[name] = self.list(indent) if lists else self.block(indent + 1)
        return self._ended(out, indent)

    def _ended(self, out, indent: int):
        now = self.next()
        if now and now[0] > indent:
            raise ValueError(f"a line too deep: {now[1]}")
        return out

    def value(self, text: str, least: int):
        """A value that begins with ``text`` and may go on in lines indented by ``least`` or more."""
        if m := _BLOCK.match(text):
            return self._literal(m[1], m[2], least)
        if text[0] in "&*!%@`":
            raise ValueError(f"not read: {text}")
        if text[0] in "\"'[{":
            whole = text
            while (found := _flow(whole)) is None:  # goes on in the next line
                if self.at >= len(self.lines):
                    raise ValueError(f"not closed: {text}")
                whole += "\n" + self.lines[self.at]
                self.at += 1
            return found[0]
        parts = [text]
        while self.at < len(self.lines) and not re.search(r"(?:^|\s)#", parts[-1]):
            line = self.lines[self.at].rstrip("\r")
            if line.strip() and (len(line) - len(line.lstrip(" ")) < least):
                break
            if line.strip() and _KEY.match(line.strip()):
                raise ValueError(f"a key within a value: {line}")
            parts.append(line)
            self.at += 1
        return _plain(_folded(re.sub(r"(?:^|\s+)#.*", "", "\n".join(parts).strip())))

    def _literal(self, style: str, end: str, least: int) -> str:
        taken: list[str] = []
        while self.at < len(self.lines) and (not self.lines[self.at].strip() or len(self.lines[self.at]) - len(self.lines[self.at].lstrip(" ")) >= least):
            taken.append(self.lines[self.at].rstrip("\r"))
            self.at += 1
        indent = next((len(x) - len(x.lstrip(" ")) for x in taken if x.strip()), 0)
        text = "\n".join(x[indent:] for x in taken)
        body = text.rstrip("\n")
        if style == ">":
            body = re.sub(r"(?<!\n)\n(?![\n ])", " ", body)
            body = re.sub(r"(?<=[^\n ])\n(\n+)(?=[^\n ])", r"\1", body)
        return body + ("" if end == "-" or not body else text[len(text.rstrip("\n")) :] + "\n" if end == "+" else "\n")


def _flow(text: str):
    """(value,) of a text that is one quoted value or one list or mapping in brackets; None if it is not closed yet."""
    found = _flow_at(text, 0)
    if found is None:
        return None
    value, at = found
    if re.sub(r"(?:^|\s+)#.*", "", text[at:]).strip():
        raise ValueError(f"more behind a value: {text[at:]}")
    return (value,)


def _flow_at(text: str, at: int):
    """(value, end) of what begins at a place, None if it is not closed."""
    while at < len(text) and text[at] in " \n\t\r":
        at += 1
    if at == len(text):
        return None
    if text[at] in "\"'":
        m = (_DOUBLE if text[at] == '"' else _SINGLE).match(text, at)
        if not m:
            return None
        return (_unescaped(re.sub(r"\\\n[ \t]*", "", _folded(m[1]) if "\n" in m[1] else m[1])) if text[at] == '"' else _folded(m[1]).replace("''", "'")), m.end()
    if text[at] not in "[{":
        m = re.compile(r"(?:(?!:(?:[\s,\]}]|$))[^,\[\]{}])+").match(text, at)
        return (_plain(_folded(m[0].strip())), m.end()) if m else (None, at)
    close, out, at = ("]", [], at + 1) if text[at] == "[" else ("}", {}, at + 1)
    while True:
        while at < len(text) and text[at] in " \n\t\r":
            at += 1
        if at == len(text):
            return None
        if text[at] == close:
            return out, at + 1
        found = _flow_at(text, at)
        if found is None:
            return None
        item, at = found
        at += len(text[at:]) - len(text[at:].lstrip(" \n\t\r"))
        if close == "}":
            value = None
            if text[at : at + 1] == ":":
                found = _flow_at(text, at + 1)
                if found is None:
                    return None
                value, at = found
                at += len(text[at:]) - len(text[at:].lstrip(" \n\t\r"))
            out[item if isinstance(item, str) else json.dumps(item)] = value
        else:
            out.append(item)
        if at >= len(text):
            return None
        if text[at] == ",":
            at += 1
        elif text[at] != close:
            raise ValueError(f"neither , nor {close}: {text[at:]}")


def to_json(text: str | None) -> str | None:
    """A block of YAML as JSON text, keys in their order; of repeated keys the last counts. Null, and what cannot be read, is null; an empty block is {}."""
    if text is None:
        return None
    try:
        lines = _Lines(text)
        found = lines.block(0)
        return None if lines.next() else json.dumps({} if found is None else found, ensure_ascii=False, allow_nan=False)
    except (ValueError, RecursionError):
        return None


_PLAIN = re.compile(r"[^\s\"'#&*!|>%@`{}\[\],?:\-=<~.][^\n\r\t\x00-\x1f]*")
_ODD = re.compile("[\x7f-\x9f\u2028\u2029\ufeff\ud800-\udfff]")


def _scalar(value) -> str:
    """A value in one line. Strings that mean something else, or could not stand plain, are quoted; --- is the border of a block, so it is escaped."""
    if isinstance(value, str):
        if _PLAIN.fullmatch(value) and not re.search(r":(?:\s|$)|\s#|\s$|---", value) and not _ODD.search(value) and isinstance(_plain(value), str):
            return value
        return json.dumps(value, ensure_ascii=bool(_ODD.search(value))).replace("---", "--\\u002d")
    if isinstance(value, float):
        return re.sub(r"^(-?\d+)e", r"\1.0e", repr(value))
    return "null" if value is None else json.dumps(value) if not isinstance(value, (dict, list)) else "{}" if isinstance(value, dict) else "[]"


def _written(value, indent: int, out: list[str]) -> None:
    """Lines of a mapping or list; an entry's own lists stand at its indent, mappings two deeper."""
    pad = " " * indent
    entries = [(f"{_scalar(k)}:", v) for k, v in value.items()] if isinstance(value, dict) else [("-", v) for v in value]
    for head, item in entries:
        if not isinstance(item, (dict, list)) or not item:
            out.append(f"{pad}{head} {_scalar(item)}")
        else:
            out.append(pad + head)
            _written(item, indent if isinstance(value, dict) and isinstance(item, list) else indent + 2, out)


def to_yaml(text: str | None) -> str | None:
    """JSON text as a block of YAML without a last line end; what is no mapping or list is null."""
    value = json.loads(text) if text is not None else None
    if not isinstance(value, (dict, list)):
        return None
    out: list[str] = []
    _written(value, 0, out)
    return "\n".join(out) if value else _scalar(value)


# Rows of Python, not Arrow batches: a worker holds 100 whole texts at a time (spark.sql.execution.python.udf.maxRecordsPerBatch), an Arrow batch has 10,000.
read = F.udf(to_json, StringType(), useArrow=False)
write = F.udf(to_yaml, StringType(), useArrow=False)


def document(fields: Column, body: Column) -> Column:
    """A Markdown document of fields (JSON text) and a body; without fields the body alone."""
    return F.coalesce(F.concat(F.lit("---\n"), write(fields), F.lit("\n---\n\n"), body), body)


def parsed(text: Column) -> Column:
    """(front: VARIANT, json, body) of a Markdown document; front and json are null where there is no front matter or it cannot be read."""
    parts = L.front_matter(text)
    found = read(parts["raw_yaml"])
    return F.struct(F.parse_json(found).alias("front"), found.alias("json"), parts["body"].alias("body"))


def added(fields: Column, name: str, value: Column) -> Column:
    """Fields (JSON text) with one more, ``value`` (JSON text), unless they have it, though as null, or the value is null."""
    lacking = ~F.array_contains(F.coalesce(F.json_object_keys(fields), F.array().cast("array<string>")), name) & value.isNotNull()
    comma = F.when(F.size(F.json_object_keys(fields)) > 0, ", ").otherwise("")
    return F.when(lacking, F.concat(F.regexp_replace(fields, r"\}\s*\z", ""), comma, F.lit(json.dumps(name, ensure_ascii=False) + ": "), value, F.lit("}"))).otherwise(fields)
