"""Parameter sheets: sections of ``KEY=VALUE`` lines, tables or FASTA text; parsed as data, never executed."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

MODES = ("uptag", "downtag", "virtual")


def sections(text: str) -> dict[str, str]:
    """Text of each section between ``#BEGIN NAME`` and ``#END NAME``; an unclosed section raises."""
    out: dict[str, str] = {}
    name, lines = None, []
    for line in text.splitlines():
        if m := re.match(r"#\s*BEGIN\s+(\S.*?)\s*$", line):
            if name:
                raise ValueError(f"section {m[1]} begins inside {name}")
            name, lines = m[1], []
        elif name and re.match(rf"#\s*END\s+{re.escape(name)}\s*$", line):
            out[name], name = "\n".join(lines), None
        elif name:
            lines.append(line)
    if name:
        raise ValueError(f"section {name} has no end")
    return out


def assignments(text: str) -> dict[str, str]:
    """``KEY=VALUE`` lines; comments and blank lines are skipped, quotes around values dropped."""
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        m = re.match(r"([A-Za-z_]\w*)=(?:\"([^\"]*)\"|'([^']*)'|([^#]*?))\s*(?:#.*)?$", line)
        if not m:
            raise ValueError(f"not an assignment: {line}")
        out[m[1]] = next(g for g in m.groups()[1:] if g is not None)
    return out


def table(text: str) -> list[dict[str, str]]:
    """Rows of a tab-separated table with a header line."""
    lines = [x.split("\t") for x in text.splitlines() if x.strip()]
    return [dict(zip(lines[0], x, strict=True)) for x in lines[1:]]


@dataclass(frozen=True)
class LibraryParameters:
    """Parameters of a library run, checked when made."""

    title: str
    barcode: str
    orf_start: int
    orf_end: int
    max_drops: int
    min_quality: float
    min_jaccard: float
    min_matches: int
    max_diff: int
    min_call_quality: int
    mode: str

    def __post_init__(self) -> None:
        checks = {
            "orf_start": self.orf_start >= 1,
            "orf_end": self.orf_end > self.orf_start and (self.orf_end - self.orf_start + 1) % 3 == 0,
            "max_drops": self.max_drops >= 0,
            "min_jaccard": 0 < self.min_jaccard <= 1,
            "min_matches": self.min_matches >= 1,
            "max_diff": 0 <= self.max_diff <= 3,
            "min_call_quality": self.min_call_quality >= 1,
            "mode": self.mode in MODES,
            "barcode": bool(re.fullmatch("[ACGTRYSWKMBDHVN]+", self.barcode)),
        }
        if wrong := [f"{k}={getattr(self, k)}" for k, ok in checks.items() if not ok]:
            raise ValueError("invalid parameters: " + ", ".join(wrong))

    @classmethod
    def parse(cls, text: str, section: str = "ARGUMENTS") -> "LibraryParameters":
        """From a sheet whose section holds a line ``NAME=value`` for each field (names in any case, ``_`` optional)."""
        given = {k.lower().replace("_", ""): v for k, v in assignments(sections(text)[section]).items()}
        values = {}
        for f in fields(cls):
            key = f.name.replace("_", "")
            if key not in given:
                raise ValueError(f"{f.name} is missing")
            kind = {"int": int, "float": float, "str": str}[f.type]
            try:
                values[f.name] = kind(given[key])
            except ValueError:
                raise ValueError(f"{f.name}={given[key]} is no {f.type}") from None
        return cls(**values)
