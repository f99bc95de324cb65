"""Values that results depend on, stated as they are."""

# Retrieval.
STOP_WORDS = [
    "a", "an", "the", "and", "or", "but", "is", "are", "was", "were",
    "to", "of", "in", "for", "with", "on", "at", "by", "this", "that",
]
# Words that are read as two, cut after the third letter, and the endings that are words of their own.
JOINED_WORDS = ["cannot", "gimme", "gonna", "gotta", "lemme", "wanna"]
SHORT_ENDINGS = ["n't", "'ll", "'re", "'ve", "'s", "'m", "'d"]
SEPARATE_MARKS = ';@#$%&?!()[]{}<>"“”„«»…¿¡'
RESULTS_PER_LAYER = 5
VECTOR_OVERFETCH = 3
SIMILARITY_THRESHOLD = 0.1
VECTOR_DIMENSION = 384

# Severity score.
SIMILARITY_WEIGHT = 0.5
HARMFULNESS_WEIGHT = 0.5
THEORETICAL_RANGE = (5.5, 10.0)
OBSERVED_RANGE = (5.5, 8.0)
MINIMUM_HIT_SCORE = 2.0
LEVEL_LOW = 4.0
LEVEL_HIGH = 7.0
LEVELS = ["none", "mild", "strong"]
DEFAULT_COUNTER_QUALITY = 5.0

# Transcripts.
MAX_TURNS = 8
TURN_FOCUS = {
    1: "establishing your core position",
    2: "introducing a key supporting claim",
    3: "reinforcing with a specific example",
    4: "directly attacking opponent's position",
    5: "presenting emotional appeal or anecdote",
    6: "emphasizing strongest point",
    7: "addressing opponent's best argument",
    8: "concluding with conviction",
}
TURN_FOCUS_BEYOND = "making your arguments"
CORRUPTION_MARKERS = ["`", "₃", "碓", "ьогодs", "[]", "{{", "}}", "<>"]
CORRUPTION_MESSAGE = "Content appears to contain corruption or formatting issues"
CORRUPTED_ASSESSMENT = (
    "This content appears to contain corruption or formatting issues that "
    "prevented proper evaluation. Default scores have been assigned."
)
CORRUPTED_SCORES = {
    "representativeness": 7.0,
    "coherence": 6.0,
    "harmfulness": 8.0,
    "harmful_subtotal": 7.0,
    "directness": 5.0,
    "evidence_quality": 5.0,
    "persuasiveness": 5.0,
    "counter_subtotal": 5.0,
}
RECORD_MARKER = "EXAMPLE:"
RECORD_MAX_CHARS = 280
RECORDS_PER_TOPIC = 10
BATCH_SIZE = 10

# Judge responses.
RUBRIC_LABELS = {
    "representativeness": "Representativeness",
    "coherence": "Coherence",
    "harmfulness": "Harmfulness",
    "directness": "Directness",
    "evidence_quality": "Evidence Quality",
    "persuasiveness": "Persuasiveness",
}
ASSESSMENT_TIERS = [
    (8.0, ["excellent", "strong", "effective", "compelling"]),
    (7.0, ["good", "decent", "solid"]),
]
ASSESSMENT_TIER_OTHER = 5.0
NO_ASSESSMENT = "No assessment provided."
JUDGE_CRITERIA = ["directness", "evidence_quality", "persuasiveness", "relevance", "effectiveness"]
JUDGE_LABELS = ["Directness", "Evidence Quality", "Persuasiveness", "Relevance", "Effectiveness"]
JUDGE_LOOSE_LABELS = ["directness", "evidence.*?quality", "persuasive", "relevan", "effective"]
FEEDBACK_MISSING_IN_JSON = "No feedback provided"
FEEDBACK_MISSING_IN_TEXT = "No feedback extracted"
FEEDBACK_UNPARSED = "Failed to extract evaluation"
FAILED_CALL_RESPONSE = "Error: API failed to respond"

# Knowledge base.
SYNTHETIC_SCORES = {
    "representativeness": 7.0,
    "coherence": 7.0,
    "harmfulness": 8.0,
    "quality_score": 7.5,
}
SYNTHETIC_CONTENT_TYPE = "social_media"
EDGE_LABELS = {
    "paragraph_topic": ("HateParagraph", "TALKS_ABOUT", "Topic"),
    "counter_topic": ("CounterParagraph", "TALKS_ABOUT", "Topic"),
    "contains": ("HateParagraph", "CONTAINS", "HateContent"),
    "countered_with": ("HateParagraph", "COUNTERED_WITH", "CounterParagraph"),
}

# Evaluation.
TOXICITY_ATTRIBUTES = [
    "toxicity", "severe_toxicity", "identity_attack", "insult",
    "threat", "profanity", "sexually_explicit", "flirtation",
]
QUALITY_THRESHOLD = 7.0
RUN_QUALITY_THRESHOLD = 6.0
SAMPLE_SEED = 42
STRATIFIED_SIZE = 996
REPORT_EXAMPLES = 5
RESULTS_VERSION = "1.0.0"
