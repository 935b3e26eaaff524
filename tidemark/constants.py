"""Fixed values.

Everything here must equal the published data formats and scoring settings for
results to match: word lists, thresholds, patterns and vocabularies.
"""

# --- text ------------------------------------------------------------------

# The characters str.strip()/str.split() treat as white space in Python 3.
PY_SPACE = "".join(
    chr(cp)
    for cp in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
               *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
PY_SPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_ASCII = r"[^\x00-\x7F]"

# Substitutions of the three ASCII policies.
CLEANING_SUBSTITUTIONS = {
    "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"',
    "\u2013": "-", "\u2014": "--", "\u2026": "...", "\u00a0": " ",
}
INGEST_SUBSTITUTIONS = {
    "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"',
    "\u2013": "-", "\u2014": "--", "\u2026": "...", "\u00a0": " ",
    "\u2192": "->", "\u2190": "<-", "\u00d7": "x", "\u2212": "-",
    "\u2010": "-", "\u2011": "-",
}
PUBLISHING_SUBSTITUTIONS = {
    "\u2192": "->", "\u2190": "<-", "\u2014": " -- ", "\u2013": "-",
    "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"',
    "\u2026": "...", "\u00a0": " ",
}
MOJIBAKE_LEADS = ("\u00c2", "\u00c3", "\u00e2")

# --- research enrichment ---------------------------------------------------

WORDS_PER_MINUTE = 225
CODE_PATTERN = (
    r"```|`[^`]+`|def [\p{L}\p{N}_]+\(|class [\p{L}\p{N}_]+[:(]"
    r"|import [\p{L}\p{N}_]+|function [\p{L}\p{N}_]+\("
)
HIGH_RELEVANCE = (
    "alignment", "existential", "x-risk", "doom", "superintelligence",
    "mesa-optimization", "inner alignment", "outer alignment",
    "reward hacking", "deceptive alignment", "treacherous turn",
)
MEDIUM_RELEVANCE = (
    "safety", "robustness", "interpretability", "transparency",
    "fairness", "bias", "explainability", "verification",
)
RESEARCH_MARKS = (
    "theorem", "proof", "lemma", "corollary", "methodology",
    "experimental setup", "we propose", "our contribution", "novel approach",
)
TUTORIAL_MARKS = (
    "introduction to", "beginner", "how to", "step by step", "tutorial",
    "getting started", "for example", "let's", "first, second, third",
)
TOPIC_KEYWORDS = {
    "interpretability": ("interpretability", "explainability", "transparency"),
    "alignment": ("alignment", "value learning", "reward modeling"),
    "robustness": ("robustness", "adversarial", "distribution shift"),
    "governance": ("governance", "policy", "regulation", "coordination"),
    "capabilities": ("capabilities", "scaling", "performance"),
    "rl": ("reinforcement learning", "rl", "reward"),
    "llm": ("language model", "llm", "gpt", "transformer"),
}
TRACKING_PARAMETERS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
)

# --- quality score ---------------------------------------------------------

NEWSLETTER_TITLE = (
    r"\[an #\d+\]", "alignment newsletter", "newsletter", "linkpost", "link post",
    r"\[linkpost\]", r"links for [\p{L}\p{N}_]+", "weekly.*digest", "monthly.*roundup",
    "weekly.*review", "monthly.*review", "^links:",
)
NEWSLETTER_TEXT = (r"\[an #\d+\]", "alignment newsletter")
QUALITY_WEIGHTS = {
    "venue": 3.0, "authors": 1.0, "not_newsletter": 2.0, "over_5k": 1.0,
    "over_10k": 1.0, "before_2020": 1.0, "tags": 0.5,
}
QUALITY_TIERS = (("A", 7.0), ("B", 4.0), ("C", 2.0))
LEADING_VENUES = ("arxiv", "distill")
FORUM_SOURCES = ("lesswrong", "alignmentforum", "eaforum")

# --- timeline events -------------------------------------------------------

REACTIONS_BY_RELEVANCE = {
    "High": (
        "This is a significant contribution to alignment research",
        "Important work advancing our understanding of AI safety",
        "Critical insights for the field",
    ),
    "Medium": (
        "Useful research for the community",
        "Interesting perspective on safety challenges",
        "Adds to our knowledge base",
    ),
    "Low": (
        "Tangentially related to core safety concerns",
        "Provides general AI context",
        "Background research",
    ),
}
MEDIA_BY_SOURCE = {
    "arxiv": "Published in academic venue",
    "alignmentforum": "Discussed in AI safety community",
    "lesswrong": "Shared in rationalist community",
    "eaforum": "Featured in effective altruism discussions",
    "deepmind": "Released by major AI lab",
    "openai": "Released by major AI lab",
    "anthropic": "Released by major AI lab",
}
MEDIA_DEFAULT = "Shared in AI safety research community"
TIERED_SAFETY_REACTIONS = (
    "Important contribution to the field",
    "Advances our understanding of AI safety",
    "Valuable research for alignment",
    "Significant technical contribution",
    "Notable work on AI safety",
)
TIERED_MEDIA_REACTIONS = {
    "arxiv": ("Published in academic venue", "Academic research release",
              "Peer-reviewed publication"),
    "distill": ("Featured in Distill", "Interactive research publication",
                "Visual machine learning research"),
}
TIERED_MEDIA_DEFAULT = (
    "Shared in AI safety community", "Published online", "Community discussion",
)
IMPACT_LEVELS = (("Critical", 150), ("High", 80), ("Medium", 30))

# --- candidates ------------------------------------------------------------

CLOCKS = ("occurred_at", "published_at", "source_available_at")
CANDIDATE_KINDS = (
    "model_release", "publication", "incident", "policy", "org_event", "funding",
    "forum_post", "benchmark",
)
PRIVACY_PHRASES = (
    "has passed away", "passed away", "in memoriam", "obituary", "memorial",
    "rest in peace", "RIP", "died", "death of", "suicide", "mental health",
    "my diagnosis", "my illness", "cancer", "harassment", "misconduct", "abuse",
    "allegations", "restraining order", "court case", "divorce",
)
DEFAULT_PROFILE = {
    "profile_id": "default_v1",
    "version": "1.0.0",
    "shrinkage_k": 12,
    "tier_quantiles": [["A", 0.05], ["B", 0.20], ["C", 0.50]],
    "kind_scoring": {
        "model_release": {
            "primary_signal": "training_compute_flop", "transform": "log10",
            "bonus_field": "frontier_model", "bonus_values": ["true", "yes", "1"],
            "bonus": 1.0,
            "fallback_signal": "citations", "fallback_transform": "log10_plus1",
        },
        "forum_post": {"primary_signal": "karma", "transform": "identity"},
        "publication": {"primary_signal": "citations", "transform": "log10_plus1"},
        "incident": {"primary_signal": None, "transform": "identity"},
    },
    "relevance": {
        "kinds_always_relevant": ["model_release"],
        "weights": {"two_or_more_hits": 1.0, "one_hit": 0.75, "no_hits": 0.25},
        "terms": [
            "ai", "agi", r"a\.i\.", "alignment", "aligned", "interpretability",
            "machine learning", "ml", "language model", "llms?", "existential risk",
            "x-risk", "compute", "scaling", "governance", "safety", "forecasting",
            "takeoff", "mesa-?optimi", "deceptive", "eval(uation)?s?", "robustness",
            "superintelligence", "transformer", "neural", "frontier model",
            "agent(ic)?", "doom", "catastroph", "extinction", "anthropic", "openai",
            "deepmind", "gpt", "claude", "llama",
        ],
    },
}
SHORTLIST_TERMS = {
    "funding_catastrophe": (
        "funding", "funder", "grant", "grants", "donor", "donation", "money",
        "budget", "runway", "salary", "salaries", "philanthrop", "ftx",
        "openphil", "open phil", "endowment", "fundrais", "invest", "raise",
        "financial", "bankrupt", "clawback", "payout", "cost",
    ),
    "organizational_crisis": (
        "resign", "resignation", "left ", "leaving", "quit", "fired",
        "departure", "depart", "board", "ceo", "leadership", "coup", "ousted",
        "staff", "team", "hiring", "layoff", "restructur", "merger",
        "acquisition", "spin out", "spinout", "split", "founder", "exodus",
        "shut down", "shutdown", "closure", "dissolv", "scandal", "drama",
    ),
    "institutional_decay": (
        "governance", "policy", "regulat", "oversight", "institution",
        "accountab", "transparen", "audit", "compliance", "safety team",
        "safety case", "commitment", "broken promise", "walked back",
        "conflict of interest", "capture", "lobby", "whistleblow", "nda",
        "non-disparage", "charter", "mission",
    ),
}

# --- tagger ----------------------------------------------------------------

TAG_SMOOTHING = 0.5
TAG_MIN_MARGIN = 0.15
TAG_MIN_TOKENS = 4
TAG_MIN_TOKEN_LENGTH = 3
TAG_STOPWORDS = tuple("""
the and for that with from this which are may can not but has have had was were
its their they them there then than when where what who whom whose will would
should could been being into onto upon over under about after before during
such some more most other others any all each both few own same too very
also however therefore thus while because although though due via per
ai system systems model models human humans use used using user users
risk risks harm harms result results lead leads leading cause causes caused
example examples including include includes e.g i.e etc
""".split())

# --- watch list ------------------------------------------------------------

TITLE_STOPWORDS = (
    "the", "a", "an", "and", "or", "of", "to", "in", "on", "for", "its", "it",
    "at", "by", "with", "over", "after", "as", "is", "are", "first", "new",
    "ai", "us", "own",
)
STRONG_TITLE_OVERLAP = 0.50
DATED_TITLE_OVERLAP = 0.30
CLOSE_DAYS = 3
CITED_SLUG = r"[a-z0-9]+(?:_[a-z0-9]+){2,}"
WATCH_HUMAN_FIELDS = (
    "watch_status", "watching_since", "decided_on", "decided_by",
    "decision_note", "rating", "cleared_for", "note",
)

# --- labs and evidence -----------------------------------------------------

REGISTRY_MARKS = (
    "companies house", "company-information.service.gov.uk",
    "recherche-entreprises", "annuaire des entreprises", "sec form",
    "form 10-k", "form 10-q", "statutory register",
)
MONTH_WORDS = (
    ("january", "jan"), ("february", "feb"), ("march", "mar"), ("april", "apr"),
    ("may",), ("june", "jun"), ("july", "jul"), ("august", "aug"),
    ("september", "sept", "sep"), ("october", "oct"), ("november", "nov"),
    ("december", "dec"),
)

# --- grants ----------------------------------------------------------------

ORGANISATION_MARKS = (
    "Inc", "LLC", "Ltd", "Foundation", "Institute", "Center", "Lab",
    "University", "College", "Fund",
)

# --- dump metadata ---------------------------------------------------------

DUMP_REQUIRED = (
    "extraction_date", "source_name", "source_url", "extraction_method",
    "data_format", "extraction_status",
)
DUMP_METHODS = ("web_scrape", "manual", "api")
DUMP_STATUSES = ("complete", "partial", "failed", "pending")

# --- scan claims -----------------------------------------------------------

SCAN_CONFIDENCE = ("high", "low", "medium")
SCAN_DATE_KINDS = ("action", "reported", "contested", "unverified")
# --- taxonomy and maturity -------------------------------------------------

TERM_STATUSES = ("ruled", "proposed", "contested")

# --- privacy ---------------------------------------------------------------

REDACTION = "[email address redacted]"
INSTITUTION_WINDOW = 160
STATE_POSTCODES = {
    "NSW": ((1000, 2599), (2619, 2899), (2921, 2999)),
    "ACT": ((200, 299), (2600, 2618), (2900, 2920)),
    "VIC": ((3000, 3999), (8000, 8999)),
    "QLD": ((4000, 4999), (9000, 9999)),
    "SA": ((5000, 5799), (5800, 5999)),
    "WA": ((6000, 6797), (6800, 6999)),
    "TAS": ((7000, 7799), (7800, 7999)),
    "NT": ((800, 899), (900, 999)),
}
STREET_TYPES = (
    "St", "Street", "Rd", "Road", "Ave", "Avenue", "Av", "Ln", "Lane", "Ct",
    "Court", "Dr", "Drive", "Pl", "Place", "Way", "Cres", "Crescent", "Terrace",
    "Tce", "Parade", "Pde", "Hwy", "Highway", "Blvd", "Boulevard", "Close",
    "Grove", "Esplanade", "Circuit", "Cct", "Walk", "Rise", "Mews", "Row",
    "Square", "Sq",
)
STREET_SUFFIXES = (
    "str", "strasse", "straat", "straede", "gasse", "weg", "platz", "allee",
    "laan", "vej", "gata", "gatan",
)
INSTITUTION_WORDS = (
    "Universit(?:y|e|at|eit|ies)", "Universidad", "Universita", "Univ",
    "Institut(?:e|es|o|ion)?", "Inc", "Incorporated", "Ltd", "Limited", "LLC",
    "LLP", "GmbH", "AG", "BV", "NV", "SA", "PLC", "plc", "Corp", "Corporation",
    "Company", "Co", "Department", "Dept", "Faculty", "School", "College",
    "Academy", "Laborator(?:y|ies)", "Lab", "Labs", "Librar(?:y|ies)",
    "Cent(?:er|re)", "Hospital", "Clinic", "Foundation", "Trust", "Council",
    "Ministry", "Agency", "Bureau", "Office", "Campus", "Building", "Hall",
    "Suite", "Museum", "Catapult", "Research", "Association", "Society",
    "Consortium", "Group", "Division", "Unit of", "Chair of", "Hochschule",
    "Fachhochschule", "Politecnico", "Ecole", "Escuela", "CNRS", "INRIA",
    "Business School", "Graduate School", "Medical", "Observatory",
)

# Address patterns. The local part may be a brace group; the domain may carry
# one space around its dots and hyphens, as text extracted from documents does.
MAIL_LOCAL = r"(?:\{[^{}@]{1,200}\}|[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63})"
MAIL_LABEL = r"[A-Za-z0-9][A-Za-z0-9\-]{0,62}"
MAIL_DOMAIN = (
    MAIL_LABEL + r"(?:" + PY_SPACE_CLASS + r"?[.\-]" + PY_SPACE_CLASS + "?" + MAIL_LABEL + ")*"
    + PY_SPACE_CLASS + r"?\." + PY_SPACE_CLASS + "?[A-Za-z]{2,24}"
)
MAIL = MAIL_LOCAL + PY_SPACE_CLASS + "*@" + PY_SPACE_CLASS + "*" + MAIL_DOMAIN
TRUNCATION_MARKER = "(?:\\.\\.\\.|\u2026)"
SEVERED_ADDRESS = MAIL_LOCAL + r"@(?:[A-Za-z0-9][A-Za-z0-9.\-]{0,23})?"
MAIL_RESIDUE = (
    r"[A-Za-z0-9][\p{L}\p{N}_.%+\-{}, ]{0,80}@" + PY_SPACE_CLASS
    + r"?[\p{L}\p{N}_.\- ]{1,80}\." + PY_SPACE_CLASS + "?[A-Za-z]{2,24}"
)
URL_RUN = r"(?:https?://|www\.)[^\s\"'<>)\]}]+"
_STREET = "(?:" + "|".join(STREET_TYPES) + ")"
# label -> (pattern, skipped inside a URL, skipped near an institution)
POSTAL_PATTERNS = {
    "UNIT_DWELLING": (
        r"\b(?:Unit|Apt|Apartment|Flat|Villa|Townhouse)\s*\.?\s*\d{1,4}"
        r"(?:\s*[/,-]\s*\d{1,5})?\s*[,/]?\s+(?:[A-Z][A-Za-z'-]+\s+){1,3}" + _STREET + r"\b",
        False, False),
    "AU_LOCALITY": (
        r"\b[A-Z][a-zA-Z'-]+(?:\s+[A-Z][a-zA-Z'-]+)?[\s,]+"
        r"(?:NSW|VIC|QLD|WA|SA|TAS|ACT|NT)[\s,]+\d{4}\b",
        False, False),
    "BARE_GEOCODE": (r"[-+]?\d{1,3}\.\d{4,}\s*,\s*[-+]?\d{1,3}\.\d{4,}", True, False),
    "PERSONAL_PHONE": (
        r"(?:\b(?:Mobile|Cell|Cellular|Home|Handy)\b[ \t]*(?:phone|no\.?|number)?[ \t]*:"
        r"[ \t]*\+?\d[\d\s.-]{7,15}\d)"
        r"|(?:(?<![\w.])(?:\+?61[\s.-]?4|04)\d{2}[\s.-]?\d{3}[\s.-]?\d{3}(?![\w.]))",
        True, False),
    "STREET_NUMBER_FIRST": (
        r"\b\d{1,5}[A-Za-z]?(?:[-/]\d{1,5}[A-Za-z]?)?\s+(?:[A-Z][A-Za-z'-]+\s+){1,3}"
        + _STREET + r"\b",
        True, True),
    "STREET_NUMBER_LAST": (
        r"\b[A-Z][a-zA-Z'-]{2,}(?:" + "|".join(STREET_SUFFIXES) + r")\.?\s?\d{1,4}\b",
        True, True),
}
INSTITUTION = r"\b(?:" + "|".join(INSTITUTION_WORDS) + r")\b"

#: Fields of a research record that must be there and not empty.
RESEARCH_REQUIRED = ("id", "source", "title", "text", "url", "date_published")
#: Fields of a research dump's metadata.
RESEARCH_METADATA = ("extraction_date", "source_name", "source_url", "extraction_method", "data_format",
                     "record_count")

#: Names that promise a judgement without saying whose.
BARE_OPINIONS = ("importance", "pdoom_impact", "quality", "rarity", "rating", "salience", "score", "tier",
                 "verdict")
#: Dates of a record that need an entry of the same name in its provenance.
DATED_FIELDS = ("occurred_at", "published_at", "source_available_at")
