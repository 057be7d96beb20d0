"""Column expressions used by the operators."""

from .numeric import band, fixed_text, per_capita, percent_change, weighted
from .text import (clean_text, contains_any, decode_entities, decode_redirect, document_text,
                   html_to_text, is_article_link, is_listing_page, iso_text, normalize_key,
                   parse_rfc822, place_phrase, published_at, publisher, resolve_alias,
                   search_phrase, search_url, stable_id, standardize_name, to_ts, url_component)

__all__ = [
    "band", "clean_text", "contains_any", "decode_entities", "decode_redirect", "document_text",
    "fixed_text", "html_to_text", "is_article_link", "is_listing_page", "iso_text",
    "normalize_key", "parse_rfc822", "per_capita", "percent_change", "place_phrase",
    "published_at", "publisher", "resolve_alias", "search_phrase", "search_url", "stable_id",
    "standardize_name", "to_ts", "url_component", "weighted",
]
