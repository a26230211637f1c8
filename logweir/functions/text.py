"""Line clean-up and strict JSON objects."""

from pyspark.sql import Column, functions as F

# Every character that counts as white space for stripping, not only the blank.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

_NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
_DOUBTFUL = r"\}\s*[\],]"


def quoted(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: str) -> Column:
    """`text`, an SQL expression, without white space at both ends."""
    return F.expr(f"btrim({text}, {literal(WHITESPACE)})")


def not_blank(text: str) -> Column:
    """True where some character is no white space; cheaper than stripping first."""
    return F.expr(f"{text} RLIKE {literal(_NOT_BLANK)}")


def json_object(line: str) -> Column:
    """Map of a line that is exactly one JSON object, else null.

    `from_json` ignores text after the first value. Read as the only element of an
    array, trailing text is malformed unless it starts with `]` or `,`; read as a
    member of an object, unless it starts with `}` or `, "key":`. No text passes both.
    The second reading is only needed where `}` is followed by `]` or `,`.
    """
    options = "map('allowSingleQuotes', 'false')"
    in_array = f"from_json(concat('[', {line}, ']'), 'array<map<string,string>>', {options})"
    in_object = (
        f"from_json(concat('{{\"w\":', {line}, ',\"e\":1}}'), 'w map<string,string>, e int', {options})"
    )
    return F.expr(
        f"CASE WHEN startswith({line}, '{{') AND endswith({line}, '}}') "
        f"AND (NOT {line} RLIKE {literal(_DOUBTFUL)} OR {in_object}.w IS NOT NULL) "
        f"THEN {in_array}[0] END"
    )


def last_key_wins(m: str) -> Column:
    """Keep the last value of a key that a JSON object repeats."""
    keys = f"array_distinct(map_keys({m}))"
    last = f"element_at(filter(map_entries({m}), e -> e.key = k), -1).value"
    unique = f"map_from_entries(transform({keys}, k -> struct(k, {last})))"
    return F.expr(f"IF(size({keys}) < size({m}), {unique}, {m})")
