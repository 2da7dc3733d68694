"""Fixed values that must equal the behaviour being reproduced.

They are stated once, plainly, in natural order; every operator takes them
as default parameters so callers can pass their own tables instead.
"""

# --- fixed values: entity name aliases (old name -> canonical name) ---------
ENTITY_ALIASES = {
    "West Germany": "Germany",
    "FRG": "Germany",
    "East Germany": "Germany",
    "Soviet Union": "Russia",
    "Zaire": "DR Congo",
    "Yugoslavia": "Serbia",
    "Serbia and Montenegro": "Serbia",
    "Dutch East Indies": "Indonesia",
    "Czechoslovakia": "Czech Republic",
    "IR Iran": "Iran",
}

# --- fixed values: ordinal stage scale, weakest first (score = position) ----
STAGE_ORDER = [
    "group stage",
    "round of 16",
    "quarter-finals",
    "semi-finals",
    "fourth place",
    "third place",
    "runner-up",
    "winner",
]

# --- fixed values: outcome target stage sets (lower-case) -------------------
CHAMPION_STAGES = ["winner"]
TOP4_STAGES = ["winner", "runner-up", "third place", "fourth place", "semi-finals"]
TOP8_EXTRA_STAGES = ["quarter-finals"]

# --- fixed values: truthy words for yes/no text columns ----------------------
TRUTHY_WORDS = ["true", "yes", "1", "oui"]

# --- fixed values: consecutive-edition rule ----------------------------------
EDITION_GAP = 4                      # editions at most this far apart are consecutive
EDITION_GAP_EXCEPTIONS = [(1938, 1950)]   # (previous, current) pairs also consecutive

# --- fixed values: upset / favourite thresholds ------------------------------
UPSET_STRENGTH = 1750
UPSET_LIST_STRENGTH = 1800
FAVOURITE_STRENGTH = 1950
FAVOURITE_MIN_STAGE_SCORE = 4
UPSET_DEFAULT_STAGE_SCORE = 2        # used when the chosen stage is not on the scale

# --- fixed values: outcome model configuration -------------------------------
MODEL_FEATURES = [
    "wc_appearances",
    "wc_titles",
    "elo_rating",
    "host_nation",
    "consecutive_wc_appearances",
    "is_debut",
]
MODEL_TREES = 300
MODEL_DEPTH = 6
MODEL_SEED = 42

STAGE_SCORE = {name: i for i, name in enumerate(STAGE_ORDER)}
