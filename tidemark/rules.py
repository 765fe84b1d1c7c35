"""Business rules of the engagement model, all of them parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that results depend on.
EVENT_TYPES = ("post", "like", "share", "comment", "repost")
TIER_FLOORS = (("HOT", 12000.0), ("TRENDING", 10000.0), ("ACTIVE", 5000.0))
LOWEST_TIER = "NORMAL"


@dataclass(frozen=True)
class EngagementRules:
    """Thresholds and weights; the defaults are the standard model."""

    event_types: tuple[str, ...] = EVENT_TYPES
    post_type: str = "post"
    # A post is viral strictly above both limits.
    viral_likes: int = 5000
    viral_shares: int = 1000
    like_weight: float = 1.0
    share_weight: float = 2.0
    comment_weight: float = 1.5
    # Highest floor first; a floor belongs to its tier.
    tier_floors: tuple[tuple[str, float], ...] = TIER_FLOORS
    lowest_tier: str = LOWEST_TIER
    mart_rank: int = 10
    trend_window: str = "5 minutes"
    trend_lateness: str = "10 minutes"

    @property
    def tiers(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.tier_floors) + (self.lowest_tier,)


DEFAULT_RULES = EngagementRules()
