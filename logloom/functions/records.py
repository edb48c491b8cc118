"""Scalar functions over records: status, waits, addresses, references, times."""

from __future__ import annotations

from collections.abc import Mapping
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import SPACE, bound

#: Statuses that have a bucket of their own name or another.
BUCKETS = {"SUCCESS": "success", "FAILED": "failed", "TIMEOUT": "failed", "ABANDONED": "abandoned", "UNKNOWN": "invalid/unknown"}
INFRASTRUCTURE_BUCKET = "invalid/infrastructure-error"
#: What providers say when they are asked too often.
RATE_LIMIT = r"\b429\b|(?i:\btoo many requests\b)|(?i:\brate[\s_-]?limit(?:ed|s)?\b)"
RETRY_AFTER = r"""(?i)retry[-_ ]?after["'\s:=]+([^"',;)\s]+)"""
#: What counts as a number of seconds; words like Infinity don't.
NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
MOST_MS = 9.2e18
HTTP_DATE = "dd MMM yyyy HH:mm:ss z"
#: A mention with its label and reference, or a bare reference.
ANY_CHAR = r"[^\n\r\x{2028}\x{2029}]"
MENTION = rf"@\[((?:\\{ANY_CHAR}|[^\\\]])*+)\]\((session:(?:(?!{SPACE})[^)])*+)\)|(session:[A-Za-z0-9_-]+)"
#: highlighter's grammars and their file name suffixes.
GRAMMARS = {
    "typescript": "ts tsx mts cts", "javascript": "js jsx mjs cjs", "shellscript": "sh bash zsh", "fish": "fish", "json": "json jsonc jsonl ndjson ipynb",
    "csv": "csv", "python": "py pyw pyi", "ruby": "rb rake gemspec", "go": "go", "rust": "rs", "java": "java", "c": "c h", "cpp": "cc cpp cxx hh hpp hxx",
    "csharp": "cs", "kotlin": "kt kts", "swift": "swift", "php": "php", "yaml": "yaml yml", "toml": "toml", "ini": "ini conf cfg properties", "dotenv": "env",
    "log": "log", "diff": "diff patch", "http": "http", "markdown": "md markdown", "mdx": "mdx", "rst": "rst", "latex": "tex sty cls", "bibtex": "bib",
    "asciidoc": "adoc", "html": "html htm xhtml", "css": "css", "scss": "scss", "less": "less", "sql": "sql", "xml": "xml xsd xsl xslt plist svg", "lua": "lua",
    "bat": "bat cmd", "powershell": "ps1 psm1 psd1", "r": "r", "julia": "jl", "dart": "dart", "scala": "scala", "clojure": "clj cljs edn", "erlang": "erl hrl",
    "elixir": "ex exs", "haskell": "hs", "fsharp": "fs fsi fsx", "vb": "vb", "perl": "pl pm", "verilog": "v", "system-verilog": "sv svh", "graphql": "graphql gql",
    "proto": "proto", "hcl": "tf tfvars hcl", "nix": "nix", "vue": "vue", "svelte": "svelte", "make": "makefile mk", "cmake": "cmake", "groovy": "gradle groovy",
}
#: Grammars whose short name isn't the grammar's own, and suffixes that stand for themselves.
SHORT_NAMES = {
    "typescript": "ts", "javascript": "js", "shellscript": "sh", "python": "py", "ruby": "rb", "rust": "rs", "csharp": "cs", "markdown": "md", "latex": "tex",
    "bibtex": "bib", "asciidoc": "adoc", "powershell": "ps1", "julia": "jl", "clojure": "clj", "erlang": "erl", "elixir": "ex", "haskell": "hs", "fsharp": "fs",
    "perl": "pl", "verilog": "v", "system-verilog": "sv",
}
OWN_NAMES = ("tsx", "jsx", "tf", "tfvars", "gradle")
#: Zones that are UTC under another name.
UTC_NAMES = ("Etc/UTC", "Etc/UCT", "Etc/GMT", "Etc/Zulu", "Etc/Universal", "Etc/Greenwich")
ZONE = r"\A[A-Za-z][A-Za-z0-9_+.-]*(?:/[A-Za-z0-9_+.-]+)+\z"


def bucket_for(status: Column, error_class: Column | None = None) -> Column:
    """The dataset bucket of a finished task; other statuses are errors."""
    chosen = F.lit(None).cast("string")
    for name, bucket in BUCKETS.items():
        chosen = F.when(status == name, bucket).otherwise(chosen)
    infrastructure = F.lit(False) if error_class is None else F.coalesce(error_class == "infrastructure", F.lit(False))
    return F.coalesce(chosen, F.when(infrastructure, INFRASTRUCTURE_BUCKET).otherwise("failed"))


def _seconds_ms(seconds: Column) -> Column:
    """Milliseconds of a number of seconds, at most what a long holds."""
    ms = F.floor(seconds * 1000 + 0.5)
    return F.when(seconds * 1000 >= MOST_MS, F.lit(2**63 - 1)).otherwise(F.when(seconds * 1000 < MOST_MS, ms.cast("long")))


def retry_after_ms(value: Column, now_ms: Column) -> Column:
    """Milliseconds that a Retry-After value asks for: a finite number of seconds, or an HTTP date."""
    text = F.regexp_replace(value, r"^\s+|\s+$", "")
    seconds = F.when(text.rlike(NUMBER), text.try_cast("double"))
    finite = F.abs(seconds) < float("inf")
    at = F.unix_millis(F.try_to_timestamp(F.regexp_replace(text, "^[A-Za-z]{3}, ", ""), F.lit(HTTP_DATE)))
    return F.when(F.coalesce(finite, F.lit(False)), F.when(seconds >= 0, _seconds_ms(seconds))).otherwise(F.when(at.isNotNull(), F.greatest(F.lit(0).cast("long"), at - now_ms)))


def is_rate_limit(message: Column) -> Column:
    return message.rlike(RATE_LIMIT)


def message_retry_after_ms(message: Column, now_ms: Column) -> Column:
    """The wait that a rate-limit message states; null for none or another message."""
    stated = F.nullif(F.regexp_extract(message, RETRY_AFTER, 1), F.lit(""))
    digits = F.nullif(F.regexp_extract(stated, r"^(\d+)", 1), F.lit("")).try_cast("double")
    digits = F.when(digits < float("inf"), _seconds_ms(digits))
    return F.when(is_rate_limit(message), F.coalesce(retry_after_ms(stated, now_ms), digits))


def _by_suffix(path: Column, names: dict[str, str]) -> Column:
    """What ``names`` has for the lower-cased suffix behind the last dot of the last segment."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./\\]*)\z", 1))
    return F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[suffix]


def file_language(path: Column) -> Column:
    """The highlighter's grammar for a file name or path; null for an unlisted suffix."""
    return _by_suffix(path, {suffix: grammar for grammar, suffixes in GRAMMARS.items() for suffix in suffixes.split()})


def read_language(path: Column) -> Column:
    """The short language name that a read of this path records; null for an unlisted suffix."""
    return _by_suffix(path, {suffix: suffix if suffix in OWN_NAMES else SHORT_NAMES.get(grammar, grammar) for grammar, suffixes in GRAMMARS.items() for suffix in suffixes.split()})


def canonical_zone(zone: Column, links: Mapping[str, str] | None = None) -> Column:
    """A caller's zone in its canonical spelling; null unless it is UTC or a known Area/Location.

    Case doesn't matter but for UTC.  ``links`` gives the zones that others are but
    aliases of; without it only the names of UTC are resolved.
    """
    known = {name.lower(): name for name in sorted(available_timezones()) if "/" in name}
    known |= {name.lower(): "UTC" for name in UTC_NAMES} | {name.lower(): other for name, other in (links or {}).items()}
    names = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.when(zone == "UTC", zone).when(zone.rlike(ZONE), names[F.lower(zone)])


def blob_key(content: Column) -> Column:
    return F.sha2(content, 256)


def blob_shard(key: Column) -> Column:
    return F.substring(key, 1, 2)


def spill_folder(session_id: Column) -> Column:
    """Twelve hex digits that name a session's folder."""
    return F.substring(F.sha2(session_id, 256), 1, 12)


def safe_name(name: Column) -> Column:
    """A path segment for any text; different texts have different ones.

    Characters other than letters, digits, dot, dash and underscore become ~ and four
    upper-case hex digits for each UTF-16 unit; so do the dots of "." and "..".  Empty
    text becomes ~.
    """
    coded = F.transform(F.split(name, ""), lambda c: F.when(c.rlike(r"\A[A-Za-z0-9._-]?\z"), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-16BE")), "(.{4})", "~$1")))
    return F.when(name == "", "~").when(name.isin(".", ".."), F.regexp_replace(name, r"\.", "~002E")).otherwise(F.array_join(coded, ""))


def session_reference(session_id: Column) -> Column:
    """A reference URI: the id as a JSON string in unpadded base64url."""
    value = bound(F.to_json(F.struct(session_id.alias("v"))), lambda quoted: F.substring(quoted, F.lit(6), F.char_length(quoted) - 6))
    coded = F.regexp_replace(F.translate(F.base64(F.encode(value, "UTF-8")), "+/", "-_"), "[=\r\n]", "")
    return F.concat(F.lit("session:"), coded)


def referenced_session(uri: Column) -> Column:
    """The id behind a reference; null unless it is in canonical form."""

    def read(uri: Column) -> Column:
        padded = bound(F.regexp_extract(uri, r"\Asession:([A-Za-z0-9_-]+)\z", 1), lambda coded: F.rpad(coded, (F.ceil(F.char_length(coded) / 4) * 4).cast("int"), "="))
        value = F.try_validate_utf8(F.try_to_binary(F.translate(padded, "-_", "+/"), F.lit("base64")).cast("string"))
        found = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v string")["v"]
        return bound(found, lambda found: F.when(session_reference(found) == uri, found))

    return bound(uri, read)


def session_mention(session_id: Column, label: Column | None = None) -> Column:
    """A mention of a session inside a text: @[label](reference); the id where no label is given."""
    shown = session_id if label is None else F.coalesce(label, session_id)
    return F.concat(F.lit("@["), F.regexp_replace(shown, r"[\\\]]", r"\\$0"), F.lit("]("), session_reference(session_id), F.lit(")"))


def referenced_sessions(text: Column) -> Column:
    """(text, sessions) of a text with mentions and bare references.

    In the text each reads as @label (a bare reference has its session as label);
    ``sessions`` holds (session_id, label) in order, repeats included.  Null where one
    of them isn't in canonical form, and for a null text.
    """

    def read(found: Column) -> Column:
        label = F.regexp_replace(F.regexp_extract(found, MENTION, 1), rf"\\({ANY_CHAR})", "$1")
        session = referenced_session(F.concat(F.regexp_extract(found, MENTION, 2), F.regexp_extract(found, MENTION, 3)))
        return bound(session, lambda session: F.struct(session.alias("session_id"), F.when(found.startswith("@"), label).otherwise(session).alias("label")))

    def told(text: Column, sessions: Column) -> Column:
        between = F.split(text, MENTION, -1)
        shown = F.zip_with(between, sessions, lambda plain, s: F.concat(plain, F.coalesce(F.concat(F.lit("@"), s["label"]), F.lit(""))))
        whole = F.struct(F.array_join(shown, "").alias("text"), sessions.alias("sessions"))
        return F.when(text.isNotNull() & ~F.exists(sessions, lambda s: s["session_id"].isNull()), whole)

    return bound(text, lambda text: bound(F.transform(F.regexp_extract_all(text, F.lit(MENTION), F.lit(0)), read), lambda sessions: told(text, sessions)))


def canonical_header(header: Column) -> Column:
    """A request header in the form that is stored and compared.

    ``header`` has config, adapter_defaults (reasoning_effort and max_tokens, booleans)
    and tools (an array).  An empty tool list is as none, and so are defaults of which
    neither is set.
    """
    defaults = header["adapter_defaults"]
    stated = F.coalesce(defaults["reasoning_effort"], F.lit(False)) | F.coalesce(defaults["max_tokens"], F.lit(False))
    return F.struct(
        header["config"].alias("config"), F.when(stated, defaults).alias("adapter_defaults"), F.when(F.size(header["tools"]) > 0, header["tools"]).alias("tools"),
    )


def utc_millis(time: Column) -> Column:
    """Milliseconds of a timestamp without zone, read as UTC whatever the session's zone."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), time.cast("timestamp_ntz"))
    return F.unix_millis(local.cast("timestamp"))


def utc_time(ms: Column) -> Column:
    """The UTC wall clock of a time, as a timestamp without zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_millis(ms).cast("timestamp_ntz"))


def iso_time(ms: Column) -> Column:
    """ISO 8601 in UTC, with milliseconds."""
    return F.date_format(utc_time(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def zoned_time(ms: Column, zone: str) -> Column:
    """Local time, offset and zone, as 2024-01-31T12:00:00+01:00[Europe/Paris]."""
    utc = utc_time(ms)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    minutes = F.timestamp_diff("MINUTE", utc, local)
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.concat(sign, F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset, F.lit(f"[{zone}]"))


# Sequence lists ---------------------------------------------------------------


def encode_ranges(seqs: Column) -> Column:
    """Runs of three or more as [start, end], others as [value]; lists out of order stay single.

    The places where a run starts are found first; each run then gives its own part.
    """
    rising = F.aggregate(seqs, F.struct(F.lit(True).alias("ok"), F.lit(None).cast("long").alias("last")),
                         lambda s, x: F.struct((s["ok"] & (s["last"].isNull() | (x > s["last"]))).alias("ok"), x.cast("long").alias("last")))["ok"]
    # places where a run starts; a run goes on to the place before the next one's
    starts = F.filter(F.sequence(F.lit(0), F.size(seqs) - 1), lambda i: (i == 0) | (F.get(seqs, i) != F.get(seqs, i - 1) + 1))
    part = lambda a, b: F.when(b - a >= 3, F.array(F.array(F.get(seqs, a), F.get(seqs, b - 1)))).otherwise(F.transform(F.slice(seqs, a + 1, b - a), lambda x: F.array(x)))
    packed = lambda at: F.flatten(F.transform(at, lambda a, i: part(a, F.coalesce(F.get(at, i + 1), F.size(seqs)))))
    single = F.transform(seqs, lambda x: F.array(x))
    # an array of one binds the starts to a name, else they would be found anew for every run
    return F.when((F.size(seqs) > 0) & rising, F.get(F.transform(F.array(starts), packed), F.lit(0))).otherwise(single)


def decode_ranges(ranges: Column) -> Column:
    return F.flatten(F.transform(ranges, lambda r: F.sequence(F.element_at(r, 1), F.element_at(r, -1))))
