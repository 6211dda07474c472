"""What the operators are configured with: labels, thresholds, lexicons and patterns. Nothing of it is in the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# The twelve risk factors that count as events.
RISK_FACTORS = [
    "agricultural production issues",
    "conflicts and violence",
    "economic issues",
    "environmental issues",
    "food crisis",
    "forced displacement",
    "humanitarian aid",
    "land-related issues",
    "pests and diseases",
    "political instability",
    "weather shocks",
    "other",
]

# Least confidence by label; labels that aren't listed have FLOOR, risk factors RISK_THRESHOLD.
THRESHOLDS = {"location": 0.80, "event": 0.50, "date": 0.50, "organization": 0.60}
RISK_THRESHOLD = 0.40
FLOOR = 0.30

# Phrases that announce each risk factor.
GAZETTEER = {
    "agricultural production issues": ["crop failure", "harvest failure", "failed crops", "bad harvests", "cattle death", "livestock death", "lack of cultivation"],
    "conflicts and violence": ["civil war", "armed conflict", "bombing", "insurgency", "terrorism", "violent clashes", "fighting", "warfare", "siege", "airstrike"],
    "economic issues": ["economic crisis", "hyperinflation", "poverty", "unemployment", "economic collapse", "price surge"],
    "environmental issues": ["climate change", "deforestation", "environmental degradation"],
    "food crisis": ["famine", "food crisis", "food insecurity", "mass hunger", "starvation", "malnutrition", "acute hunger"],
    "forced displacement": ["displacement", "refugee crisis", "forced migration", "internally displaced", "refugee camp", "makeshift camp"],
    "humanitarian aid": ["aid appeal", "humanitarian crisis", "food aid", "relief effort", "humanitarian access"],
    "pests and diseases": ["cholera", "epidemic", "pandemic", "locust swarm", "plague", "disease outbreak", "rinderpest"],
    "political instability": ["coup", "government collapse", "regime change", "political crisis", "martial law"],
    "weather shocks": ["drought", "flood", "cyclone", "hurricane", "typhoon", "tornado", "heatwave", "frost", "rural collapse"],
    "other": ["man-made disaster"],
}

# Verbs that make a place in "in <place>" the source or the destination of a movement.
SOURCE_VERBS = ["flee", "escape", "uproot", "displace", "evacuate", "leave", "abandon", "expel", "deport", "drive", "force"]
DESTINATION_VERBS = ["arrive", "seek", "shelter", "reach", "resettle", "move", "migrate", "relocate", "settle"]

# Nouns that, after "the", stand for the whole area a document is about.
MACRO_NOUNS = ["nation", "country", "countries", "province", "provinces", "region", "regions", "republic", "territory", "territories", "state", "homeland"]

# Frequent English words that tell English text.
ENGLISH_WORDS = ["the", "and", "was", "that", "for", "with", "this", "from", "have", "has", "are", "were", "been", "not", "but", "they", "which"]


@dataclass(frozen=True)
class Config:
    """A corpus' configuration. Modes: linker all, neighbor, waterfall, nearest or full; gazetteer none, pre or post (merged before or
    after overlaps are removed); skip any or source (which events a destination is no place for)."""

    event_labels: tuple[str, ...] = ("event", *RISK_FACTORS)
    thresholds: dict[str, float] = field(default_factory=lambda: {**THRESHOLDS, **dict.fromkeys(RISK_FACTORS, RISK_THRESHOLD)})
    floor: float = FLOOR
    gazetteer: dict[str, list[str]] = field(default_factory=lambda: GAZETTEER)
    macro: str = r"(?i)\bthe\s+(?:" + "|".join(MACRO_NOUNS) + r")\b"
    source_verbs: tuple[str, ...] = tuple(SOURCE_VERBS)
    destination_verbs: tuple[str, ...] = tuple(DESTINATION_VERBS)
    linker: str = "full"
    gazetteer_mode: str = "pre"
    skip: str = "source"
