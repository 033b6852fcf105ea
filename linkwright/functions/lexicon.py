"""The word lists, patterns and parameters that results depend on."""

from __future__ import annotations

# --- Fixed values. These must equal the published ones for equal results. ---

#: Legal forms removed from names, one after the other, wherever they stand.
LEGAL_FORMS = (
    r"\bprivate\s+limited\b",
    r"\bpvt\.?\s*ltd\.?\b",
    r"\blimited\b",
    r"\bltd\.?\b",
    r"\bcorporation\b",
    r"\bcorp\.?\b",
    r"\bincorporated\b",
    r"\binc\.?\b",
    r"\bllc\.?\b",
    r"\bllp\.?\b",
    r"\bcompany\b",
    r"\bsarl\.?\b",
    r"\beurl\.?\b",
    r"\bpvt\.?\b",
)

#: Markers between a legal and a trade name; only the marker goes.
TRADE_MARKERS = r"\b(?:dba|formerly|aka)\b"

#: Address words by abbreviation.
ADDRESS_ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard",
    "dr": "drive", "ln": "lane", "ct": "court", "pl": "place",
    "sq": "square", "pkwy": "parkway", "hwy": "highway", "cir": "circle",
    "trl": "trail", "ter": "terrace", "apt": "apartment", "ste": "suite",
    "bldg": "building", "fl": "floor", "rm": "room",
    "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
    "mt": "mount", "ft": "fort", "pt": "point",
}

#: A unit's keyword and what follows it. There is no word end after the keyword, so longer words that begin with one
#: go as well; results depend on it.
UNIT = r"\b(?:unit|apartment|apt|suite|ste|room|rm|floor|fl)\s*[#]?\s*\w+"

NAME_STOPWORDS = ("the", "of", "and", "a", "an", "in", "at", "for", "to", "by", "on", "with", "from", "de", "du", "des", "le", "la", "les")

ADDRESS_STOPWORDS = (
    "the", "of", "and", "a", "an", "in", "at", "for", "to", "by", "on", "near", "behind", "beside", "opposite", "next",
    "above", "below", "no", "po", "box",
)

#: Words too common in names, and in addresses, to index.
COMPANY_WORDS = (
    "ltd", "pvt", "limited", "inc", "corp", "llc", "co", "company",
    "private", "public", "enterprises", "enterprise", "international",
    "services", "service", "technologies", "technology", "solutions",
    "solution", "group", "holdings", "holding", "global", "industries",
    "industry", "trading", "associates", "brothers", "sons", "management",
    "systems", "system", "engineering", "construction", "development",
    "business", "general", "national", "state", "bank", "trust", "fund",
    "care", "health", "centre", "center", "works",
    "india", "indian", "us", "usa", "france", "french",
    "sa", "sas", "gmbh", "bv", "nv", "sarl", "ste", "srl", "ag", "plc",
    "pte", "pty", "aps", "spa", "ooo", "zao",
    "the", "and", "for", "with",
)

STREET_WORDS = (
    "road", "street", "avenue", "lane", "drive", "rd", "st", "ave", "dr",
    "suite", "floor", "near", "opp", "dept", "boulevard", "blvd", "highway",
    "hwy", "circle", "cir", "court", "ct", "place", "pl", "square", "sq",
    "unit", "building", "bldg", "room", "rm", "box", "pob", "post", "office",
    "north", "south", "east", "west", "city", "state", "town",
)

MIN_DF, MAX_DF = 2, 1000  # documents of an indexed token
TOP_COSINE, TOP_TOKENS = 60, 40  # candidates of each channel
NAME_WEIGHT, ADDRESS_WEIGHT = 0.65, 0.35
GRAM_MIN, GRAM_MAX = 2, 4
VOCABULARY, VOCABULARY_MIN_DF, FIT_ROWS = 100_000, 2, 300_000
VALIDATION_SHARE = 0.15
NEGATIVES_PER_POSITIVE = 5
MAX_POSITIVES, MAX_PAIRS = 500_000, 3_000_000
DEFAULT_THRESHOLD = 0.85

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
MATCHING_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")

FEATURES = (
    "country_match",
    "name_levenshtein", "name_token_sort", "name_token_set", "name_partial", "name_jaccard",
    "name_contain_1in2", "name_contain_2in1", "name_ngram_jaccard", "name_len_ratio", "name_ntokens1", "name_ntokens2",
    "addr_levenshtein", "addr_token_sort", "addr_token_set", "addr_partial", "addr_jaccard",
    "addr_contain_1in2", "addr_contain_2in1", "addr_ngram_jaccard", "addr_len_ratio", "addr_ntokens1", "addr_ntokens2",
    "name_avg_sim", "addr_avg_sim", "name_addr_interaction", "min_name_addr",
    "addr_num_jaccard", "both_have_nums",
)
# --- End of the fixed values. ---
