"""Fixed values.

Everything in this module must stay equal to the behaviour being matched:
regular expressions, keyword lists, the token replacement chain and the
reference catalogue of functions.  They are listed plainly, in their natural
order, so they can be checked by eye.
"""

from __future__ import annotations

# --- Fixed values: argument extraction patterns (Python ``re`` syntax) -------
NUMBER_PATTERN = r"-?\d+\.?\d*"
SUB_SOURCE_IN_WITH = r"in\s+(?:the\s+)?(?:string\s+)?(['\"])(.*?)\1\s+with"
SUB_SOURCE_WITH_IN = r"with\s+['\"][^'\"]+['\"]\s+in\s+(['\"])(.*?)\1"
WORD_IN_QUOTES = r"word\s+['\"](\w+)['\"]"
REPLACEMENT_IN_QUOTES = r"with\s+['\"]([^'\"]+)['\"]"
PAIR_AFTER_VERB = (r"(?:concatenate|join|combine)\s+['\"]([^'\"]+)['\"]\s+"
                   r"(?:and|with)\s+['\"]([^'\"]+)['\"]")
PAIR_ANYWHERE = r"['\"]([^'\"]+)['\"]\s+(?:and|with)\s+['\"]([^'\"]+)['\"]"
ANY_QUOTED = r"['\"]([^'\"]+)['\"]"
SINGLE_QUOTED = r"'([^']*)'"
DOUBLE_QUOTED = r'"([^"]*)"'
NAME_AFTER_GREET = r"greet\s+([\w\-]+)"

# --- Fixed values: regex literals produced from phrases, in precedence order -
DIGITS_REGEX = r"\d+"
VOWELS_REGEX = r"[aeiouAEIOU]"
CONSONANTS_REGEX = r"[bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ]"
SPACES_REGEX = r"\s+"
PATTERN_PHRASES = [
    (("digit", "number"), DIGITS_REGEX),
    (("vowel",), VOWELS_REGEX),
    (("consonant",), CONSONANTS_REGEX),
    (("space", "whitespace"), SPACES_REGEX),
]
WORD_PHRASE = "word"
REPLACEMENT_PHRASES = [
    (("asterisk", "stars", "asterisks"), "*"),
    (("underscore",), "_"),
    (("nothing", "empty"), ""),
]

# --- Fixed values: functions with their own string rules ---------------------
FN_SUBSTITUTE = "fn_substitute_string_with_regex"
FN_CONCATENATE = "fn_concatenate_strings"
FN_UNARY_STRING = ("fn_reverse_string", "fn_to_uppercase", "fn_to_lowercase",
                   "fn_string_length")
FN_GREET = "fn_greet"
BOOL_CANDIDATES = ("True", "False")

# --- Fixed values: required name prefix --------------------------------------
FN_PREFIX = "fn_"

# --- Fixed values: token normalisation chain, applied in this order ----------
TOKEN_REPLACEMENTS = [
    ("Ġ", " "),
    ("Ċ", "\n"),
    ("ĉ", "\t"),
    ("▁", " "),
    ("</w>", ""),
    ("<unk>", ""),
    ("<s>", ""),
    ("</s>", ""),
    ("<pad>", ""),
    ("<mask>", ""),
]

# --- Fixed values: the reference's 20-function catalogue, in order -----------
# (fn_name, [(arg_name, arg_type), ...], return_type)
REFERENCE_CATALOG = [
    ("fn_add_numbers", [("a", "float"), ("b", "float")], "float"),
    ("fn_multiply_numbers", [("a", "float"), ("b", "float")], "float"),
    ("fn_subtract_numbers", [("a", "float"), ("b", "float")], "float"),
    ("fn_divide_numbers", [("a", "float"), ("b", "float")], "float"),
    ("fn_get_square_root", [("a", "float")], "float"),
    ("fn_power", [("base", "float"), ("exponent", "float")], "float"),
    ("fn_is_even", [("n", "int")], "bool"),
    ("fn_is_positive", [("n", "float")], "bool"),
    ("fn_reverse_string", [("s", "str")], "str"),
    ("fn_to_uppercase", [("s", "str")], "str"),
    ("fn_to_lowercase", [("s", "str")], "str"),
    ("fn_string_length", [("s", "str")], "int"),
    ("fn_greet", [("name", "str")], "str"),
    ("fn_substitute_string_with_regex",
     [("source_string", "str"), ("regex", "str"), ("replacement", "str")], "str"),
    ("fn_concatenate_strings", [("s1", "str"), ("s2", "str")], "str"),
    ("fn_factorial", [("n", "int")], "int"),
    ("fn_absolute_value", [("n", "float")], "float"),
    ("fn_max_of_two", [("a", "float"), ("b", "float")], "float"),
    ("fn_min_of_two", [("a", "float"), ("b", "float")], "float"),
    ("fn_modulo", [("a", "int"), ("b", "int")], "int"),
]

# --- Lexical scorer vocabulary (our design, not the reference's) -------------
# Name parts that say nothing about the function are not keywords.
KEYWORD_STOPWORDS = ("fn", "to", "of", "with", "get", "is", "two", "numbers", "string", "value")
# Extra words per function for the default lexical scorer.
KEYWORD_ALIASES = {
    "fn_add_numbers": ("add", "sum", "plus"),
    "fn_multiply_numbers": ("multiply", "product", "times"),
    "fn_subtract_numbers": ("subtract", "difference", "minus"),
    "fn_divide_numbers": ("divide", "quotient", "divided"),
    "fn_get_square_root": ("sqrt",),
    "fn_power": ("exponent", "raised"),
    "fn_is_even": ("even",),
    "fn_is_positive": ("positive",),
    "fn_reverse_string": ("reverse", "backwards"),
    "fn_to_uppercase": ("uppercase", "upper"),
    "fn_to_lowercase": ("lowercase", "lower"),
    "fn_string_length": ("length", "characters", "long"),
    "fn_greet": ("greet", "hello"),
    "fn_substitute_string_with_regex": ("substitute", "replace"),
    "fn_concatenate_strings": ("concatenate", "join", "combine"),
    "fn_factorial": ("factorial",),
    "fn_absolute_value": ("absolute",),
    "fn_max_of_two": ("max", "maximum", "larger"),
    "fn_min_of_two": ("min", "minimum", "smaller"),
    "fn_modulo": ("modulo", "remainder", "mod"),
}

# The texts shown to a model scorer, for a function and for an argument.
SELECTION_CONTEXT = "Available functions: {functions}. User request: {prompt}. Select best function: "
ARGUMENT_CONTEXT = "Select %s from: %s. Context: %s. Answer: "
