"""Thresholds of the operators in one place; all can be overridden."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    similarity_boundary: float = 0.5
    segment_max_units: int = 8
    segment_max_seconds: float = 300.0
    segment_max_words: int = 512
    segment_min_words: int = 20
    slice_min_words: int = 50
    keyframes: int = 10
    domain_confidence: float = 0.3
    lexical_ratio: float = 90.0
    merge_similarity: float = 0.9
    check_similarity: float = 0.75
    base_weight: float = 0.7
    frequency_weight: float = 0.3
    temporal_similarity: float = 0.75
    temporal_cap: int = 201  # the cap is tested after an edge is added
    min_cluster: int = 2
    min_topic_cluster: int = 3
    min_concepts: int = 10
    min_edges: int = 10
    max_orphan_ratio: float = 0.2
    min_coverage: float = 0.9
    max_concepts: int = 20
    first_confidence: float = 1.0
    max_relations: int = 20
    max_prerequisites: int = 10
    frames_per_video: int = 120
    chunk_rows: int = 4096


DEFAULTS = EngineConfig()

# The vocabularies of concept types, relations, domains and node types.
CONCEPT_TYPES = ["definition", "law", "formula", "process", "example", "fact"]
RELATIONS = ["requires", "explains", "leads_to", "example_of", "contains", "has_topic", "contrasts_with", "formula_for", "part_of", "applied_in", "appears_in"]
DOMAINS = ["optics", "mechanics", "chemistry", "electricity", "thermodynamics", "waves", "quantum", "biology", "mathematics", "general"]
NODE_TYPES = ["Chapter", "TopicGodNode", "AtomicConcept", "Source"]
EXTENSIONS = {
    "video": [".mp4", ".mkv", ".avi", ".mov", ".webm"],
    "pdf": [".pdf"],
    "json": [".json"],
    "text": [".txt", ".md", ".srt", ".vtt"],
    "image": [".png", ".jpg", ".jpeg", ".webp"],
}
