"""Thresholds of the crawl and of text processing, one frozen object for both."""

from __future__ import annotations

import math
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    # URL admission
    max_host_length: int = 50
    max_path_length: int = 500
    max_path_marks: int = 30
    tld_blacklist: str = r"\.tk$"
    tld_whitelist: str = ""
    tld_native: str = ""
    empty_page_internal_links: bool = True
    empty_page_external_links: bool = False
    conversion_enabled: bool = False
    # documents
    min_doc_bytes: int = 200
    max_doc_bytes: int = 10 * 1024 * 1024
    accepted_languages: tuple[str, ...] = ("en",)
    lang_diff_paragraph: float = 0.95
    keep_bad: bool = False
    allow_neargood: bool = True
    # paragraph classes
    length_low: int = 50
    length_high: int = 100
    stopwords_low: float = 0.2
    stopwords_high: float = 0.3
    max_link_density: float = 0.4
    max_good_distance: int = 5
    max_heading_distance: int = 150
    # domains
    min_docs_downloaded: int = 20
    min_bytes_downloaded: int = 256 * 1024
    yield_factor: float = 0.002
    primary_factor: float = 0.05
    max_docs_cleaned: int | None = None
    max_distance: int = 50
    host_length_tiers: tuple[int, ...] = (50,)
    distance_tiers: tuple[int, ...] = (50,)
    paths_per_selection: int = 20
    max_paths: int = 100
    min_paths: int = 20
    max_selected: int = 30_000
    max_idle_seconds: int = 3600
    robots_wait_seconds: int = 3600
    ignore_failed_robots: bool = False
    # download queue
    host_interval: float = 20.0
    ip_interval: float = 1.0
    host_queue_cap: int = 200
    open_at_once: int = 200
    max_open: int = 4000
    page_queue: int = 5000
    agent: str = "corpusweft"
    #: (queue longer than, pages of one host to take) from the top
    load_caps: tuple[tuple[int, int], ...] = field(default=((9000, 1), (3000, 3), (1500, 10), (500, 30), (-1, 100)))

    @property
    def kept_paths(self) -> int:
        """How many paths a domain keeps when it has more than ``max_paths``."""
        return (3 * self.max_paths + self.min_paths) // 4

    def yield_threshold(self, docs: int) -> float:
        return self.yield_factor * (math.log10(docs) - 1)

    def load_cap(self, queued: int) -> int:
        return next(cap for least, cap in self.load_caps if queued > least)


SMALL = Config()
LARGE = Config(
    yield_factor=0.005, min_docs_downloaded=50, min_bytes_downloaded=512 * 1024, paths_per_selection=5, min_paths=5,
    max_selected=100_000, max_idle_seconds=8 * 3600, robots_wait_seconds=3 * 3600, max_paths=250,
    host_length_tiers=(15, 30, 50), distance_tiers=(3, 5, 8, 15, 50),
)
