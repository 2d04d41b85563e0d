"""Settings, from defaults, a ``.env`` file and environment variables (``LEXMILL_`` and the field's name)."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    data_dir: str = "data"
    pdf_dir: str = "data/pdfs"
    embedding_dim: int = 384
    embedding_batch_size: int = 64
    chunk_size: int = 512
    chunk_overlap: int = 64
    top_k: int = 10
    n_lists: int = 0
    n_probe: int = 8

    @classmethod
    def load(cls, env_file: str = ".env") -> Settings:
        given = dict(os.environ)
        if Path(env_file).is_file():
            lines = (x.strip() for x in Path(env_file).read_text().splitlines())
            given = {k.strip(): v.strip().strip("'\"") for k, _, v in (x.partition("=") for x in lines if x and not x.startswith("#"))} | given
        values = {}
        for f in fields(cls):
            if (v := given.get(f"LEXMILL_{f.name.upper()}")) is not None:
                values[f.name] = type(f.default)(v)
        return cls(**values)

    def create_dirs(self) -> None:
        for d in (self.data_dir, self.pdf_dir):
            Path(d).mkdir(parents=True, exist_ok=True)
