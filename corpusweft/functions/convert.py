"""Word-processor files to text; other binary files by an external command, if there is one."""

from __future__ import annotations

import io
import re
import subprocess
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, functions as F
from .vectorised import vectorised

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_ODT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}p"
#: command lines that read a file from standard input and write its text
COMMANDS: dict[str, list[str]] = {"pdf": ["pdftotext", "-enc", "UTF-8", "-nopgbrk", "-", "-"], "ps": ["ps2ascii", "-"], "doc": ["antiword", "-"]}
PLAIN = str.maketrans({"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", " ": " ", "•": "*", "": "*"})


def _letters(n: int) -> str:
    return chr(ord("a") + (n - 1) % 26) * ((n - 1) // 26 + 1)


def _roman(n: int) -> str:
    out = ""
    for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), ("m", "cm", "d", "cd", "c", "xc", "l", "xl", "x", "ix", "v", "iv", "i")):
        out += sign * (n // value)
        n %= value
    return out


class Numbering:
    """Counters of nested lists; a level starts anew when a level above it moves on."""

    def __init__(self, xml: bytes | None) -> None:
        self.formats: dict[tuple[str, int], tuple[str, str, int]] = {}
        self.counts: dict[str, dict[int, int]] = {}
        if not xml:
            return
        root = ET.fromstring(xml)
        abstract = {a.get(_W + "abstractNumId"): a for a in root.iter(_W + "abstractNum")}
        for num in root.iter(_W + "num"):
            ref = num.find(_W + "abstractNumId")
            a = abstract.get(ref.get(_W + "val")) if ref is not None else None
            for level in a.iter(_W + "lvl") if a is not None else ():
                get = lambda tag, default: (level.find(_W + tag).get(_W + "val") if level.find(_W + tag) is not None else default)  # noqa: E731, B023
                self.formats[num.get(_W + "numId"), int(level.get(_W + "ilvl"))] = (get("numFmt", "decimal"), get("lvlText", "%1."), int(get("start", "1")))

    def label(self, num: str, level: int) -> str:
        counts = self.counts.setdefault(num, {})
        for deeper in [k for k in counts if k > level]:
            del counts[deeper]
        fmt, text, start = self.formats.get((num, level), ("bullet", "", 1))
        counts[level] = counts.get(level, start - 1) + 1
        if fmt == "bullet":
            return "* "
        def one(m: re.Match) -> str:
            at = int(m[1]) - 1
            kind = self.formats.get((num, at), ("decimal", "", 1))[0]
            n = counts.get(at, 1)
            made = {"lowerLetter": _letters(n), "upperLetter": _letters(n).upper(), "lowerRoman": _roman(n), "upperRoman": _roman(n).upper()}
            return made.get(kind, str(n))
        return re.sub(r"%(\d)", one, text) + " "


def docx_text(data: bytes, show_links: bool = False, justify: bool = False) -> str:
    """Paragraphs between blank lines; deleted text, fields and drawings are left out."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        read = lambda n: z.read(n) if n in names else None
        document, rels, numbers = z.read("word/document.xml"), read("word/_rels/document.xml.rels"), Numbering(read("word/numbering.xml"))
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(rels)} if rels else {}

    def text(node: ET.Element) -> str:
        out = []
        for x in node:
            tag = x.tag.removeprefix(_W)
            if tag in ("del", "delText", "instrText", "drawing", "pict", "object", "pPr", "rPr"):
                continue
            if tag == "t":
                out.append(x.text or "")
            elif tag in ("tab", "ptab"):
                out.append("\t")
            elif tag in ("br", "cr"):
                out.append("\n")
            elif tag == "noBreakHyphen":
                out.append("-")
            elif tag == "softHyphen":
                continue
            elif tag == "r":
                inner, style = text(x), x.find(_W + "rPr")
                if style is not None and style.find(_W + "caps") is not None:
                    inner = inner.upper()
                lift = style.find(_W + "vertAlign") if style is not None else None
                out.append(f"[{inner}]" if lift is not None and lift.get(_W + "val") == "superscript" and inner else inner)
            elif tag == "hyperlink":
                inner, to = text(x), targets.get(x.get(_R + "id"))
                out.append(f"{inner} [{to}]" if show_links and to and to != inner else inner)
            else:
                out.append(text(x))
        return "".join(out)

    lines = []
    for p in ET.fromstring(document).iter(_W + "p"):
        style = p.find(_W + "pPr")
        line = text(p)
        num = style.find(_W + "numPr") if style is not None else None
        if num is not None and num.find(_W + "numId") is not None:
            level = num.find(_W + "ilvl")
            line = numbers.label(num.find(_W + "numId").get(_W + "val"), int(level.get(_W + "val")) if level is not None else 0) + line
        side = style.find(_W + "jc") if style is not None else None
        if justify and side is not None and len(line) < 80:
            line = line.center(80).rstrip() if side.get(_W + "val") == "center" else line.rjust(80) if side.get(_W + "val") in ("right", "end") else line
        if style is not None and style.find(_W + "pBdr") is not None and not line.strip():
            line = "-" * 80
        if line.strip():
            lines.append(line if justify else line.strip())
    return "\n\n".join(lines).translate(PLAIN)


def odt_text(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("content.xml"))
    found = ("".join(p.itertext()).strip() for p in root.iter(_ODT))
    return "\n\n".join(p for p in found if p)


def convert(data: bytes | None, kind: str | None, seconds: int = 30) -> str | None:
    """Text of a file of a known kind; null if it can't be read."""
    try:
        if data is None or kind is None:
            return None
        if kind in ("docx", "odt"):
            return docx_text(data) if kind == "docx" else odt_text(data)
        if kind == "txt":
            return data.decode("utf-8", "replace")
        if kind in COMMANDS:
            return subprocess.run(COMMANDS[kind], input=data, capture_output=True, timeout=seconds, check=False).stdout.decode("utf-8", "replace")
    except (OSError, KeyError, zipfile.BadZipFile, ET.ParseError, subprocess.TimeoutExpired):
        return None
    return None


@vectorised("string")
def _converted(data: pd.Series, kind: pd.Series) -> pd.Series:
    return pd.Series([convert(None if d is None else bytes(d), k) for d, k in zip(data, kind)])


def converted(data: Column, kind: Column) -> Column:
    return _converted(data, kind)
