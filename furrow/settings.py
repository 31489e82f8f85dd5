"""Run settings. Every field has an environment override named FURROW_<FIELD>."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    # who publishes
    provider_id: str = "prov-demo"
    provider_code: str = "DEMO"
    provider_name: str = "Demo advisory provider"
    domain: str = "agriculture"
    # published vocabulary addresses
    schema_base: str = "https://schemas.example.org/schema"
    schema_version: str = "v0.1"
    taxonomy_base: str = "https://taxonomy.example.org"
    type_prefix: str = "adv"
    state_scheme: str = "ISO-3166-2"
    district_scheme: str = "DISTRICT"
    # segmentation
    min_passage_chars: int = 80
    max_passage_chars: int = 700
    # page gates
    min_page_chars: int = 40
    min_usable_ratio: float = 0.5
    thin_page_chars: int = 150
    thin_warning_ratio: float = 0.4
    subject_warning_ratio: float = 0.4
    # script detection
    lang_min_chars: int = 15
    lang_min_ratio: float = 0.05
    # text recovery from page images, off unless asked for
    ocr_enabled: bool = False
    ocr_langs: str = "hin+eng"
    ocr_dpi: int = 300
    ocr_page_text_floor: int = 150
    ocr_min_chars: int = 120
    ocr_min_topics: int = 2
    # embeddings
    embedding_backend: str = "local"
    embedding_model: str = "intfloat/multilingual-e5-large"
    embedding_dim: int = 1024
    embedding_batch: int = 16
    embedding_base_url: str = ""
    embedding_api_key: str = ""
    passage_prefix: str = "passage: "
    query_prefix: str = "query: "
    token_limit: int = 512
    # publishing
    node_url: str = ""
    publish_path: str = "/catalog/publish"
    visible_to: tuple[str, ...] = ("local-network",)
    catalog_type: str = "REGULAR"
    envelope_version: str = "2.0.0"
    validity_days: int = 365
    publish_max_attempts: int = 3
    publish_backoff_seconds: float = 1.0
    publish_timeout_seconds: float = 60.0
    ledger_limit: int = 200
    # physical knobs
    inline_alias_limit: int = 2000      # aliases of a lexicon that become expressions
    lexicon_bytes: int = 32_000_000     # of a lexicon that is read as a whole
    page_chunk: int = 1024        # pages of one document that share a task
    index_bucket_bytes: int = 512_000_000  # a bucket of the passage index is split beyond this

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, **overrides) -> "Settings":
        env = os.environ if env is None else env
        values = {}
        for f in fields(cls):
            raw = env.get("FURROW_" + f.name.upper())
            if raw is None:
                continue
            default = f.default
            if isinstance(default, bool):
                values[f.name] = raw.strip().lower() in {"1", "true", "yes"}
            elif isinstance(default, tuple):
                values[f.name] = tuple(s for s in raw.split(",") if s)
            else:
                values[f.name] = type(default)(raw)
        return replace(cls(**values), **overrides)

    def schema_url(self, capability: str) -> str:
        return f"{self.schema_base}/{capability}/{self.schema_version}/context.jsonld"

    def describe(self) -> dict[str, str]:
        """What this run will do, including what it will not."""
        lexical = self.embedding_backend == "lexical"
        return {
            "provider": f"{self.provider_id} ({self.provider_name})",
            "domain": self.domain,
            "embeddings": (
                f"lexical, {self.embedding_dim}-d, no model, semantic=false" if lexical
                else f"{self.embedding_backend}, {self.embedding_model}, {self.embedding_dim}-d"
            ),
            "node": self.node_url or "table kept by this run",
            "ocr": (
                f"requested, {self.ocr_langs}, {self.ocr_dpi} dpi" if self.ocr_enabled
                else "off: pages that are images are not read"
            ),
        }
