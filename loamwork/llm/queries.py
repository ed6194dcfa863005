"""The queries of this subpackage and their SQL; importing a module registers its query."""

from loamwork.llm import decontaminate, divergence, fingerprints, html, jaccard, language, lines, manifest, mixing, quality, toxicity, urls, warc  # noqa: F401
from loamwork.llm.common import ORACLES, QUERIES  # noqa: F401
