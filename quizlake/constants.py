"""Fixed values that must equal the original benchmark tool's for equal results.

Everything in this module is a literal value (texts, labels, parameters); no logic.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (kept verbatim so Silver rows, prompts and labels are identical)
# ---------------------------------------------------------------------------

# Generation parameters recorded on every Silver row.
PROMPT_VERSION = "v1_exact_choice"
TEMPERATURE = 0
MAX_TOKENS = 50

# Prompt template: header, then the question, then one "- choice" line per choice.
PROMPT_HEADER = (
    "Tu participes à un benchmark de culture générale.\n\n"
    "Réponds uniquement avec l'une des réponses proposées.\n"
    "Ne donne aucune explication.\n"
    "Ne donne aucune phrase supplémentaire.\n"
    "Recopie exactement la réponse choisie.\n\n"
    "Question :\n"
)
PROMPT_CHOICES_HEADER = "\n\nRéponses possibles :\n"
PROMPT_CHOICE_BULLET = "- "
PROMPT_FOOTER = "\n\nRéponse :"

# Error texts, rendered as "<ExceptionType>: <message>".
MSG_EMPTY_ITEM = "Question ou bonne réponse vide"
MSG_LIST_INVALID = "incorrect_answers : liste JSON invalide"
MSG_LIST_EMPTY = "incorrect_answers doit être une liste non vide"
MSG_LIST_BAD_ELEMENT = "incorrect_answers contient une réponse vide ou non textuelle"
MSG_UNEXPECTED_JSON = "L'API a renvoyé un JSON inattendu"
MSG_EMPTY_REPLY = "Réponse du modèle vide ou non textuelle"
MSG_TRUNCATED = "Réponse tronquée : limite max_tokens atteinte"
MSG_LITERAL_WARNING = "Liste non JSON récupérée avec ast.literal_eval."

# Report labels.
ERROR_FILL_LABEL = "Erreur non renseignée"
LABEL_OK, LABEL_WRONG, LABEL_ERROR = "OK", "FAUX", "ERREUR"

# Ordered difficulty levels.
DIFFICULTY_ORDER = ["easy", "medium", "hard"]

# Statuses.
STATUS_SUCCESS, STATUS_ERROR = "success", "error"

# Ingest: page size of the item-bank API and its response codes.
PAGE_SIZE = 50
RC_OK, RC_NO_RESULTS, RC_INVALID_PARAM, RC_TOKEN_NOT_FOUND, RC_TOKEN_EMPTY, RC_RATE_LIMIT = 0, 1, 2, 3, 4, 5

# Report columns (names of the per-level aggregate and of the detail listing).
DETAIL_COLUMNS = ["model", "category", "difficulty", "question_clean", "ai_answer",
                  "correct_answer_clean", "ai_correct", "response_time"]
REPORT_REQUIRED_COLUMNS = ["category", "type", "difficulty", "question_clean",
                           "correct_answer_clean", "model", "ai_answer", "ai_correct",
                           "response_time", "status", "error"]
BRONZE_REQUIRED_COLUMNS = ["question", "correct_answer", "incorrect_answers"]
BRONZE_DEFAULTED_COLUMNS = ["category", "type", "difficulty"]
CHECKPOINT_REQUIRED_COLUMNS = ["question_id", "model", "prompt_version", "temperature",
                               "max_tokens", "status"]
