"""Limits of a run in one place; dataclasses.replace gives others."""

from __future__ import annotations

from dataclasses import dataclass

# The four families of keys that must be equal.
FAMILIES = (("street_num", "city_norm"), ("postcode", "street_num"), ("name_acronym", "city_norm"), ("street_num", "state_canon"))


@dataclass(frozen=True)
class Knobs:
    """Defaults of blocking, training and sampling. Document-frequency limits: a fraction, a whole number, or None."""

    seed: int = 42
    tfidf_top_k: int = 20
    tfidf_df_min: int = 2
    tfidf_df_ceiling: float | int | None = 0.01
    tfidf_fallback: int = 5
    addr_df_ceiling: float | int | None = None
    exact_key_max_bucket: int = 1000
    families: tuple[tuple[str, ...], ...] = FAMILIES
    rare_df_min: int = 2
    rare_df_fraction: float | int | None = 0.005
    rare_df_max: int = 5000
    rare_per_entity: int = 3
    rare_top_k: int = 100
    embed_top_k: int = 20
    cap: int = 30
    empty_score: str = "p_none"

    def options(self) -> dict[str, dict]:
        """The options of each channel."""
        tfidf = {"k": self.tfidf_top_k, "df_min": self.tfidf_df_min, "df_ceiling": self.tfidf_df_ceiling, "fallback": self.tfidf_fallback}
        return {
            "name_tfidf": tfidf, "addr_tfidf": tfidf | {"df_ceiling": self.addr_df_ceiling}, "exact_key": {"families": [list(f) for f in self.families], "max_bucket": self.exact_key_max_bucket},
            "rare_token": {"df_min": self.rare_df_min, "df_fraction": self.rare_df_fraction, "df_max": self.rare_df_max, "per_entity": self.rare_per_entity, "top": self.rare_top_k}, "embed_ann": {"top": self.embed_top_k},
        }
