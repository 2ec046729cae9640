"""Settings of the claim pipeline: their defaults, and a reader of a settings file with sections."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

# Names in a settings file -> fields.
NAMES = {"retrieval.chunk_words": "chunk_words", "retrieval.chunk_stride": "chunk_stride", "retrieval.top_k": "top_k", "paths.pdf_dir": "sources_dir", "paths.reviews_dir": "reviews_dir", "paths.sources_text_dir": "texts_dir", "paths.outputs_dir": "outputs_dir"}


@dataclass(frozen=True)
class Settings:
    chunk_words: int = 180
    chunk_stride: int = 90
    top_k: int = 5
    max_excerpts: int = 6
    low_share: float = 0.3
    low_least: int = 10
    escalate_above: float = 0.05
    sample_salt: str = "42"
    sources_dir: str = "pilot_inputs/sources_pdf"
    reviews_dir: str = "pilot_inputs/reviews"
    texts_dir: str = "working/sources_text"
    outputs_dir: str = "outputs"


DEFAULTS = Settings()


def read_settings(text: str) -> Settings:
    """Settings from lines `section:` and, indented, `name: value`; names this pipeline has no use for are left alone, and a value that is
    no number where one belongs is an error."""
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    section, got = "", {}
    for line in text.lstrip("\ufeff").splitlines():
        m = re.match(r"(\s*)([\w-]+):\s*(.*?)\s*(?:\s#.*)?$", line)
        if not m or line.lstrip().startswith("#"):
            continue
        if not m[1]:
            section = m[2]
        name = NAMES.get(f"{section}.{m[2]}", m[2])
        if m[3] and name in kinds:
            got[name] = kinds[name](m[3].strip("\"'"))
    return Settings(**got)
