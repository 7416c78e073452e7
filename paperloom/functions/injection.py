"""Pattern tables of the prompt-injection scan and the column expressions over them."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: categories with their weights, in reporting order ----
WEIGHTS = {
    "instruction_override": 3.0,
    "role_manipulation": 2.5,
    "imperative_to_ai": 1.0,
    "database_manipulation": 2.0,
    "tool_command_injection": 3.0,
    "url_exfiltration": 1.5,
    "encoded_payload": 1.0,
}
RISK_SCALE = 4.0
RISK_MEDIUM = 40.0
RISK_HIGH = 65.0


class Pattern(NamedTuple):
    """A pattern and the lower-case texts of which every match contains at least one."""

    category: str
    label: str
    regex: str
    needs: tuple[str, ...] = ()


# ---- Fixed values: the patterns; all are matched without regard to case ----
PATTERNS = (
    Pattern(
        "instruction_override", "ignore_previous",
        r"\bignore\s+(?:all\s+|any\s+|the\s+|your\s+)?(?:previous|prior|above|preceding|earlier|foregoing)\s+"
        r"(?:instruction|instructions|prompt|prompts|context|message|messages|direction|directions)\b",
        ("ignore",),
    ),
    Pattern(
        "instruction_override", "disregard",
        r"\bdisregard\s+(?:all\s+|any\s+|the\s+|your\s+)?(?:previous|prior|above|preceding|earlier|following)?\s*"
        r"(?:instruction|instructions|prompt|prompts|context|rule|rules|guideline|guidelines)\b",
        ("disregard",),
    ),
    Pattern(
        "instruction_override", "forget",
        r"\bforget\s+(?:everything|all|any|the|your|previous|prior|above)\b",
        ("forget",),
    ),
    Pattern(
        "instruction_override", "override_instructions",
        r"\boverride\s+(?:the\s+|your\s+|all\s+|any\s+)?(?:instruction|instructions|prompt|system|rule|rules|"
        r"guardrail|guardrails)\b",
        ("override",),
    ),
    Pattern("instruction_override", "ignore_the_above", r"\bignore\s+the\s+above\b", ("ignore",)),
    Pattern("role_manipulation", "as_an_ai", r"\bas\s+an?\s+(?:AI|LLM|language\s+model|assistant|agent)\b",
            ("ai", "llm", "model", "assistant", "agent")),
    Pattern("role_manipulation", "you_are_now", r"\byou\s+are\s+now\b", ("now",)),
    Pattern("role_manipulation", "act_as", r"\b(?:act|behave|respond|reply)\s+as\s+(?:a|an|if|though)\b",
            ("act", "behave", "respond", "reply")),
    Pattern("role_manipulation", "pretend", r"\bpretend\s+(?:to\s+be|that|you)\b", ("pretend",)),
    Pattern("role_manipulation", "system_prompt", r"\bsystem\s*(?:prompt|message|role|instruction)\b", ("system",)),
    Pattern("role_manipulation", "developer_mode", r"\bdeveloper\s+mode\b", ("developer",)),
    Pattern("role_manipulation", "jailbreak", r"\bjailbreak\b|\bDAN\s+mode\b", ("jailbreak", "mode")),
    Pattern("role_manipulation", "new_persona",
            r"\bnew\s+(?:instructions|task|role|persona|system\s+prompt|directive)\b", ("new",)),
    Pattern("imperative_to_ai", "you_must", r"\byou\s+must\b", ("must",)),
    Pattern("imperative_to_ai", "you_should", r"\byou\s+should\b", ("should",)),
    Pattern("imperative_to_ai", "make_sure_to", r"\b(?:make\s+sure|be\s+sure)\s+to\b", ("sure",)),
    Pattern("imperative_to_ai", "do_not_reveal",
            r"\bdo\s+not\s+(?:tell|inform|mention|reveal|disclose|report|warn)\b", ("not",)),
    Pattern("imperative_to_ai", "from_now_on", r"\bfrom\s+now\s+on\b", ("now",)),
    Pattern("imperative_to_ai", "your_task_is", r"\byour\s+(?:task|job|goal|instruction|role)\s+is\b", ("your",)),
    Pattern("imperative_to_ai", "attention_ai",
            r"\b(?:attention|important|note|reminder)\s*[:,]?\s*(?:AI|assistant|model|agent|chatbot|LLM)\b",
            ("attention", "important", "note", "reminder")),
    Pattern("database_manipulation", "add_keyword",
            r"\badd\s+(?:the\s+)?(?:keyword|keywords|tag|tags|label|labels|term|terms|entry|field)\b", ("add",)),
    Pattern("database_manipulation", "insert_into", r"\binsert\s+(?:into|the|this|a|an)\b", ("insert",)),
    Pattern("database_manipulation", "add_to_database",
            r"\badd\s+(?:this|the\s+following|it|them)?\s*to\s+(?:the\s+)?(?:database|db|record|records|table|"
            r"metadata|index)\b", ("add",)),
    Pattern("database_manipulation", "store_following", r"\bstore\s+(?:the\s+following|this|these|it)\b", ("store",)),
    Pattern("database_manipulation", "classify_as",
            r"\b(?:classify|label|mark|tag|categorize|categorise)\s+(?:this|it|the\s+\w+)?\s*as\b",
            ("classify", "label", "mark", "tag", "categori")),
    Pattern("database_manipulation", "update_record",
            r"\bupdate\s+(?:the\s+)?(?:record|records|database|entry|row|field|metadata|table)\b", ("update",)),
    Pattern("tool_command_injection", "shell_rm", r"\brm\s+-[rf]{1,2}\b", ("rm",)),
    Pattern("tool_command_injection", "os_system", r"\bos\.system\s*\(", ("os.system",)),
    Pattern("tool_command_injection", "subprocess",
            r"\bsubprocess\.(?:run|call|Popen|check_output|check_call)\b", ("subprocess.",)),
    Pattern("tool_command_injection", "eval_exec", r"\b(?:eval|exec)\s*\(", ("eval", "exec")),
    Pattern("tool_command_injection", "dangerous_import",
            r"\b(?:import\s+os|import\s+subprocess|import\s+socket|__import__\s*\()", ("import",)),
    Pattern("tool_command_injection", "pipe_to_shell", r"\|\s*(?:bash|sh|zsh|python[0-9.]*)\b", ("|",)),
    Pattern("tool_command_injection", "download_and_run", r"\b(?:curl|wget)\s+[^\s|;`]+", ("curl", "wget")),
    Pattern("tool_command_injection", "privilege", r"\b(?:sudo|chmod|chown)\b", ("sudo", "chmod", "chown")),
    Pattern("tool_command_injection", "command_substitution", r"\$\(", ("$(",)),
    Pattern("tool_command_injection", "sql_destructive",
            r"\b(?:DROP\s+TABLE|DELETE\s+FROM|TRUNCATE\s+TABLE|;\s*DROP)\b", ("drop", "delete", "truncate")),
    Pattern("tool_command_injection", "chained_command",
            r";\s*(?:rm|curl|wget|cat|echo|python|bash|sh|nc|ncat)\b", (";",)),
    Pattern("url_exfiltration", "url", r"\b(?:https?|ftp)://[^\s<>\"')\]]+", ("://",)),
    Pattern("url_exfiltration", "exfiltrate_verb", r"\b(?:exfiltrate|exfil|leak)\b", ("exfil", "leak")),
    Pattern("url_exfiltration", "post_to_url", r"\b(?:POST|GET|PUT)\s+(?:to\s+)?(?:https?://|[a-z0-9.-]+/)", ("/",)),
    Pattern("url_exfiltration", "send_data",
            r"\b(?:send|upload|post|transmit|forward|email|e-mail|ship)\s+(?:the\s+|this\s+|your\s+|all\s+|out\s+)?"
            r"(?:data|results?|output|file|files|database|contents?|information|records?)\b",
            ("data", "result", "output", "file", "content", "information", "record")),
    Pattern("url_exfiltration", "ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{1,5})?\b"),
    Pattern("encoded_payload", "data_uri_base64", r"\bdata:[a-z0-9.+-]+/[a-z0-9.+-]+;base64,", (";base64,",)),
    Pattern("encoded_payload", "long_hex", r"\b(?:0x)?[0-9a-fA-F]{40,}\b"),
    Pattern("encoded_payload", "hex_escapes", r"(?:\\x[0-9a-fA-F]{2}){4,}", ("\\x",)),
)


def base64_pattern(min_length: int) -> Pattern:
    """The one pattern with a parameter, and the only one that minds case."""
    return Pattern(
        "encoded_payload", "base64_blob",
        rf"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{{{min_length},}}={{0,2}}(?![A-Za-z0-9+/=])",
    )


def java_regex(pattern: Pattern) -> str:
    """The pattern with Unicode classes and case rules, as Python applies them to text."""
    return pattern.regex if pattern.label == "base64_blob" else f"(?iU){pattern.regex}"


def search_form(text: Column) -> Column:
    """Lower-case copy in which the required texts can be looked up.

    Four letters equal an ASCII letter when case is ignored but are not changed into it by
    ``lower``; they are mapped first so that the cheap test never misses a match.
    """
    return F.lower(F.translate(text, "İıſK", "iisk"))


def pattern_count(text: Column, lowered: Column, pattern: Pattern) -> Column:
    """Number of non-overlapping matches; the regex runs only where a required text occurs."""
    count = F.regexp_count(text, F.lit(java_regex(pattern)))
    if not pattern.needs:
        return count
    present = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(n)) for n in pattern.needs])
    return F.when(present, count).otherwise(0)


def risk_level(score: Column, matches: Column) -> Column:
    return (
        F.when(matches == 0, "none")
        .when(score >= RISK_HIGH, "high")
        .when(score >= RISK_MEDIUM, "medium")
        .otherwise("low")
    )
