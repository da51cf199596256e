"""Rule library: each rule is a named boolean Column; rules are data.

A list of rules is evaluated in one projection, either to an array of
failing rule names (``reasons``) or to the first failing name in list order
(``first_failure``). A rule whose value is null counts as failed, so
missing input never passes silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and codes of the settings and transfer rules.
MONTH_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"
SHA256_PATTERN = r"^[0-9a-f]{64}$"
BUCKET_PATTERN = r"^[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]$"
IPV4_PATTERN = r"^[0-9]+(\.[0-9]+){3}$"
ISO_INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
REDACTED = "[redacted]"
ENDPOINT_SCHEMES = ("http", "https")
ACCEPTED_ENCODING = "identity"
OK_STATUS = 200
THROTTLED_STATUS = 429
DENIED_STATUSES = (401, 403)


@dataclass(frozen=True)
class Rule:
    name: str
    ok: Column


def _failed(rule: Rule) -> Column:
    return ~F.coalesce(rule.ok, F.lit(False))


def reasons(rules: Sequence[Rule]) -> Column:
    """array<string> of the names of failing rules, in rule order."""
    flagged = F.array(*[F.when(_failed(r), F.lit(r.name)) for r in rules])
    return F.filter(flagged, lambda x: x.isNotNull())


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first failing rule, or null when all pass (fixed precedence)."""
    return F.coalesce(*[F.when(_failed(r), F.lit(r.name)) for r in rules], F.lit(None).cast("string"))


def all_pass(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [~_failed(r) for r in rules])


# --- settings and naming rules -------------------------------------------------

def month_format(c: Column) -> Column:
    """Whole-string ``YYYY-MM`` with a month 01..12."""
    return c.rlike(MONTH_PATTERN)


def split_list(c: Column) -> Column:
    """Comma list → trimmed items, keeping trailing empties."""
    return F.transform(F.split(c, ",", -1), lambda x: F.trim(x))


def storage_key_rules(c: Column) -> list[Rule]:
    """Bucket-relative key: non-empty, no leading slash, no scheme."""
    return [
        Rule("empty_key", F.length(c) > 0),
        Rule("absolute_key", ~c.startswith("/")),
        Rule("uri_key", ~c.contains("://")),
    ]


def relative_path_rules(c: Column) -> list[Rule]:
    """Storage key rules plus: no '..' segment, so a key can never leave its root."""
    return [*storage_key_rules(c), Rule("parent_segment", ~c.rlike(r"(^|/)\.\.(/|$)"))]


def bucket_rules(c: Column) -> list[Rule]:
    """Object-store bucket naming."""
    return [
        Rule("bucket_charset", c.rlike(BUCKET_PATTERN)),
        Rule("bucket_double_dot", ~c.contains("..")),
        Rule("bucket_dot_dash", ~c.contains(".-") & ~c.contains("-.")),
        Rule("bucket_ip_address", ~c.rlike(IPV4_PATTERN)),
    ]


def endpoint_rules(url: Column) -> list[Rule]:
    """HTTP(S) origin without credentials, query, fragment or path."""
    def part(name: str) -> Column:
        return F.try_parse_url(url, F.lit(name))
    return [
        Rule("endpoint_scheme", part("PROTOCOL").isin(*ENDPOINT_SCHEMES)),
        Rule("endpoint_host", part("HOST").isNotNull() & (part("HOST") != "")),
        Rule("endpoint_userinfo", part("USERINFO").isNull()),
        Rule("endpoint_query", part("QUERY").isNull()),
        Rule("endpoint_fragment", part("REF").isNull()),
        Rule("endpoint_path", F.coalesce(part("PATH"), F.lit("")).isin("", "/")),
    ]


# --- transfer and retry rules ---------------------------------------------------

def response_rules(status: Column, encoding: Column, received: Column,
                   declared: Column) -> list[Rule]:
    """Acceptance of a fetched body, in the order the checks are made."""
    return [
        Rule("http_status", status == OK_STATUS),
        Rule("content_encoding",
             F.lower(F.coalesce(encoding, F.lit(ACCEPTED_ENCODING))) == ACCEPTED_ENCODING),
        Rule("empty_body", received > 0),
        Rule("length_mismatch", declared.isNull() | (declared == received)),
    ]


def fetch_retryable(status: Column, error_kind: Column) -> Column:
    """Fetch errors: 429 and 5xx retry, other HTTP statuses do not; I/O and timeouts retry."""
    return (F.when(error_kind.isin("io", "timeout"), F.lit(True))
            .when(status.isNotNull(),
                  (status == THROTTLED_STATUS) | status.between(500, 599))
            .otherwise(F.lit(False)))


def storage_retryable(chain: Column) -> Column:
    """Storage errors from a cause chain ``array<struct<kind string, status int>>``.

    Denied (401/403 or an access-denied cause anywhere) and permanent causes
    (invalid input, conflict) never retry; otherwise the first service error
    in the chain decides (429 or ≥ 500); otherwise the outermost error is
    judged: I/O, timeout and client transport errors retry (C13).
    """
    denied = F.exists(chain, lambda e: (e["kind"] == "access_denied")
                      | ((e["kind"] == "service") & e["status"].isin(*DENIED_STATUSES)))
    permanent = F.exists(chain, lambda e: e["kind"].isin("invalid_input", "conflict", "unstopped"))
    services = F.filter(chain, lambda e: e["kind"] == "service")
    first_service = F.element_at(services, 1)
    outermost = F.element_at(chain, 1)
    return (F.when(denied | permanent, F.lit(False))
            .when(F.size(services) > 0,
                  (first_service["status"] == THROTTLED_STATUS) | (first_service["status"] >= 500))
            .otherwise(F.coalesce(outermost["kind"].isin("io", "timeout", "client"), F.lit(False))))


def error_text(message: Column, kind: Column) -> Column:
    """The message of an error, or its class where it has none."""
    return F.coalesce(F.nullif(message, F.lit("")), kind)


def backoff_millis(attempt: Column, base_millis: int = 1000, cap_millis: int = 30000) -> Column:
    """Wait before attempt ``attempt`` (1-based): min(cap, base × (attempt − 1))."""
    return F.when(attempt <= 1, F.lit(0).cast("bigint")).otherwise(
        F.least(F.lit(cap_millis).cast("bigint"), (attempt - 1).cast("bigint") * base_millis))


# --- text helpers ---------------------------------------------------------------

def redact(c: Column, secrets: Sequence[str]) -> Column:
    """Literal replacement of every non-empty secret."""
    out = c
    for s in secrets:
        if s:
            out = F.replace(out, F.lit(s), F.lit(REDACTED))
    return out


def occurrences(c: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal, counted in bytes."""
    removed = F.replace(c, F.lit(needle), F.lit(""))
    return ((F.octet_length(c) - F.octet_length(removed)) / len(needle.encode())).cast("bigint")


def iso_instant_ok(c: Column) -> Column:
    """UTC instants with whole seconds or a fraction of one to nine digits."""
    return F.try_to_timestamp(F.regexp_replace(c, r"\.[0-9]{1,9}Z$", "Z"), F.lit(ISO_INSTANT_FORMAT)).isNotNull()


def sha256_ok(c: Column) -> Column:
    return c.rlike(SHA256_PATTERN)
