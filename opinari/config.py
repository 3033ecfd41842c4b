"""Lexicons, context rules and thresholds as plain dataclasses.

No configuration file format is read here: callers pass a :class:`Lexicon`
(or use one of the fixed ones below) to the aspect and sentiment operators.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Aspect:
    """One aspect: found when any keyword occurs (substring of lower-cased text)
    and, for context-ruled aspects, when every context group also has a word
    that occurs."""

    name: str
    keywords: tuple[str, ...]
    context: tuple[tuple[str, ...], ...] = ()


@dataclass(frozen=True)
class Lexicon:
    aspects: tuple[Aspect, ...]

    @property
    def names(self) -> list[str]:
        return [a.name for a in self.aspects]

    def without_context(self) -> "Lexicon":
        """The notebook form of extraction: keywords only, no context rules."""
        return Lexicon(tuple(Aspect(a.name, a.keywords) for a in self.aspects))


@dataclass(frozen=True)
class LexiconScorer:
    """Word-count sentiment scorer: x = #positive words present - #negative
    words present; p = sigmoid(x); label positive if x > 0 else negative."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]


@dataclass(frozen=True)
class Thresholds:
    min_comment_length: int = 10          # strict ``len > n`` on raw text
    clean_min_length: int = 10            # inclusive range on cleaned text
    clean_max_length: int = 5000
    low_confidence: float = 0.7
    high_confidence: float = 0.9
    very_long_text: int = 1000
    max_request_comments: int = 1000
    max_comment_chars: int = 5000
    min_extraction_rows: int = 100
    max_missing_share: float = 0.5
    short_mean_length: float = 20.0
    release_min_accuracy: float = 0.85
    comments_per_page: int = 100


@dataclass(frozen=True)
class CleaningConfig:
    remove_stopwords: bool = True
    lemmatize: bool = True
    remove_punctuation: bool = False
    supported_languages: tuple[str, ...] = ("en",)


# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Aspect lexicon of the reference configuration, in its order; ``complex`` is
# listed twice there and kept twice here (it does not change any result).
# Context rules: bash_the_leader needs "leader" and one of target/attack/beat/stop;
# downtime needs one of wait/idle/turn and one of long/boring/slow.
REFERENCE_LEXICON = Lexicon((
    Aspect("luck", ("luck", "chance", "random", "alea")),
    Aspect("bookkeeping", ("recording", "bookkeeping", "rulebook", "manual", "tracking", "record")),
    Aspect("downtime", ("downtime", "waiting", "idle", "turn"),
           (("wait", "idle", "turn"), ("long", "boring", "slow"))),
    Aspect("interaction", ("interaction", "influence", "impact", "affect")),
    Aspect("bash_the_leader", ("bash the leader", "target the leader", "attack the leader"),
           (("leader",), ("target", "attack", "beat", "stop"))),
    Aspect("complexity", ("complicated", "complex", "rules", "difficult", "complex")),
))

# Fallback English check of the reference: any of these occurs as a substring.
ENGLISH_WORDS = ("the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by")

# Tokens that pandas ``read_csv`` turns into a missing value by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")

# Class index -> label of the two-class sentiment model.
CLASS_LABELS = ("negative", "positive")
SENTIMENT_LABELS = ("positive", "negative", "unknown")
ANALYSIS_TYPES = ("sentiment", "absa", "both")

# Noun suffix rules (suffix, replacement) used by the lemma job, in order.
NOUN_SUFFIX_RULES = (("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
                     ("shes", "sh"), ("men", "man"), ("ies", "y"), ("s", ""))

# Spark ML's default English stop-word list (StopWordsRemover), used for T6.
SPARK_ENGLISH_STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split())

# ---------------------------------------------------------------------------
# Test lexicon and scorer over the driver's invented-language documents
# (the reference lexicon's keywords never occur in them).
# ---------------------------------------------------------------------------

FIXTURE_LEXICON = Lexicon((
    Aspect("plain_a", ("tion",)),
    Aspect("plain_b", ("that", "with")),
    Aspect("ctx_wait", ("this", "sich", "pour"), (("ther", "der", "les"), ("from", "von", "pas"))),
    Aspect("ctx_lead", ("thin", "than"), (("th",), ("rewh", "orre"))),
))

FIXTURE_SCORER = LexiconScorer(positive=("that", "with"),
                               negative=("this", "from", "sich", "pour"))

DEFAULT_THRESHOLDS = Thresholds()


@dataclass(frozen=True)
class QualityRule:
    """Threshold row for the quality-metric table: ``higher_is_better`` decides
    the direction; ``warn_margin`` widens the good band into a warning band."""

    metric_name: str
    threshold: float
    higher_is_better: bool
    warn_margin: float


QUALITY_RULES = (
    QualityRule("avg_length", 20.0, True, 10.0),
    QualityRule("empty_ratio", 0.01, False, 0.04),
    QualityRule("short_ratio", 0.05, False, 0.10),
    QualityRule("avg_confidence", 0.7, True, 0.1),
    QualityRule("low_confidence_ratio", 0.3, False, 0.2),
    QualityRule("quality_score", 80.0, True, 20.0),
)


@dataclass(frozen=True)
class AlertRule:
    alert_type: str
    metric: str
    threshold: float
    severity: str


ALERT_RULES = (
    AlertRule("error_rate_high", "error_pct", 22.0, "high"),
    AlertRule("error_rate_critical", "error_pct", 30.0, "critical"),
)
