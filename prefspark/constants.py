"""Fixed values of the data format and the default run settings."""

# The seven rubric criteria, in report order.
CRITERIA = (
    "Clarity",
    "Specificity",
    "Completeness",
    "Safety",
    "Answerability",
    "Conciseness",
    "FormatConsistency",
)

# Fixed value: the line that opens a rubric block.
RUBRIC_HEADER = "Evaluation:"

# Text that marks the start of the next user turn in generated output.
STOPS = (
    "\n<|start_header_id|>user<|end_header_id|>",
    "<|start_header_id|>user<|end_header_id|>\n\n",
    "\nuser",
    "User:",
    "user\n\n",
    "<|user|>",
)

# Responses per instruction and their seed.
N_RESPONSES = 2
SEED = 42

# Context budgets in units.
MAX_CONTEXT = 4096
MAX_NEW = 512

# Run defaults.
SAMPLE_FRACTION = 0.5
MAX_ROUNDS = 3
MAX_RETRIES = 3

# Failure reasons of the rubric report.
PARSE_FAILURE = "invalid_instruction_or_feedback_parse_failed"
EXCEPTION_PREFIX = "exception: "

# Routes of a row within a round.
ACCEPTED = "accepted"
REFINE = "refine"
CACHED = "cached"
INVALID = "invalid"
