"""How a MySQL function is written in Spark SQL.

A template takes the rendered arguments. Functions that are not listed have the same name and meaning in Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from marlstone.plans.errors import SqlError

Template = Callable[[list[str]], str]

AGGREGATES = set(
    """COUNT SUM MIN MAX AVG ANY_VALUE GROUP_CONCAT LISTAGG STD STDDEV STDDEV_POP STDDEV_SAMP VARIANCE VAR_POP VAR_SAMP BIT_AND BIT_OR BIT_XOR
    APPROX_COUNT_DISTINCT FIRST LAST COLLECT_LIST COLLECT_SET GROUPING GROUPING_ID JSON_ARRAYAGG""".split()
)


def same(name: str) -> Template:
    return lambda a: f"{name}({', '.join(a)})"


def number_or_null(name: str) -> Template:
    """NaN becomes NULL."""
    return lambda a: f"nanvl({name}({', '.join(a)}), CAST(NULL AS DOUBLE))"


def all_known(name: str) -> Template:
    """NULL if any argument is."""
    return lambda a: f"CASE WHEN {' OR '.join(f'({x}) IS NULL' for x in a)} THEN NULL ELSE {name}({', '.join(a)}) END"


def insert(a: list[str]) -> str:
    s, pos, n, new = a
    return f"CASE WHEN ({pos}) < 1 OR ({pos}) > char_length({s}) THEN {s} ELSE concat(left({s}, ({pos}) - 1), {new}, CASE WHEN ({n}) < 0 OR ({pos}) + ({n}) > char_length({s}) THEN '' ELSE substring({s}, ({pos}) + ({n})) END) END"


def substring(a: list[str]) -> str:
    if a[1].lstrip("-").isdigit() and int(a[1]) != 0:
        return f"substring({', '.join(a)})"
    return f"CASE WHEN ({a[1]}) = 0 THEN '' ELSE substring({', '.join(a)}) END"


def truncate(a: list[str]) -> str:
    x, d = a
    return f"(CASE WHEN ({x}) >= 0 THEN floor(({x}) * pow(10, {d})) ELSE ceil(({x}) * pow(10, {d})) END / pow(10, {d}))"


def elt(a: list[str]) -> str:
    return f"CASE {a[0]} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(a[1:], 1)) + " END"


def date_shift(sign: str) -> Template:
    def shift(a: list[str]) -> str:
        if a[0].startswith("'"):  # text is a date, or a date and a time
            a = [f"CAST({a[0]} AS {'DATE' if len(a[0]) <= 12 else 'TIMESTAMP_NTZ'})", a[1]]
        return f"({a[0]} {sign} {a[1]})" if a[1].upper().startswith(("INTERVAL", "MAKE_INTERVAL")) else f"date_add({a[0]}, {'-' if sign == '-' else ''}({a[1]}))"

    return shift


#: MySQL date format codes and Java's; fixed values.
FORMATS = {"Y": "yyyy", "y": "yy", "m": "MM", "c": "M", "d": "dd", "e": "d", "H": "HH", "k": "H", "h": "hh", "I": "hh", "i": "mm", "s": "ss", "S": "ss", "f": "SSSSSS", "p": "a", "M": "MMMM", "b": "MMM", "W": "EEEE", "a": "EEE", "j": "DDD", "T": "HH:mm:ss", "%": "%"}


def java_format(quoted: str) -> str:
    if not quoted.startswith("'"):
        raise SqlError("a date format has to be a literal")
    out, body, i = [], quoted[1:-1], 0
    while i < len(body):
        if body[i] == "%" and i + 1 < len(body):
            out.append(FORMATS.get(body[i + 1], body[i + 1]))
            i += 2
        else:
            out.append(f"\\'{body[i]}\\'" if body[i].isalpha() else body[i])
            i += 1
    return "'" + "".join(out) + "'"


def each(names: str, make: Callable[[str], Template]) -> dict[str, Template]:
    return {n.upper(): make(n) for n in names.split()}


FUNCTIONS: dict[str, Template] = {
    **each("acos asin atan atan2 cos sin tan sqrt pow power log2 cot exp", number_or_null),
    **each("greatest least", all_known),
    "LOG": lambda a: f"ln({a[0]})" if len(a) == 1 else f"log({', '.join(a)})",
    "INSERT": insert,
    "CHAR": lambda a: f"concat_ws('', {', '.join(f'char({x})' for x in a)})",
    "ELT": elt,
    "SUBSTRING": substring,
    "LENGTH": same("octet_length"),
    "LEN": same("char_length"),
    "OCTET_LENGTH": same("octet_length"),
    "CHARACTER_LENGTH": same("char_length"),
    "UCASE": same("upper"),
    "LCASE": same("lower"),
    "MOD": lambda a: f"(({a[0]}) % nullif({a[1]}, 0))",
    "IFNULL": same("coalesce"),
    "NIL": lambda a: "NULL",
    "TRUNCATE": truncate,
    "CEILING": same("ceil"),
    "NOW": lambda a: "current_timestamp()",
    "SYSDATE": lambda a: "current_timestamp()",
    "LOCALTIME": lambda a: "current_timestamp()",
    "LOCALTIMESTAMP": lambda a: "current_timestamp()",
    "CURRENT_TIMESTAMP": lambda a: "current_timestamp()",
    "CURDATE": lambda a: "current_date()",
    "CURRENT_DATE": lambda a: "current_date()",
    "CURRENT_TIME": lambda a: "current_time()",
    "CURTIME": lambda a: "current_time()",
    "USER": lambda a: "current_user()",
    "SESSION_USER": lambda a: "current_user()",
    "DATE": same("to_date"),
    "DATE_ADD": date_shift("+"),
    "ADDDATE": date_shift("+"),
    "DATE_SUB": date_shift("-"),
    "SUBDATE": date_shift("-"),
    "WEEK": same("weekofyear"),
    "DATE_FORMAT": lambda a: f"date_format({a[0]}, {java_format(a[1])})",
    "STR_TO_DATE": lambda a: f"try_to_timestamp({a[0]}, {java_format(a[1])})",
    "JSON_EXTRACT": same("get_json_object"),
    "JSON_UNQUOTE": lambda a: f"""CASE WHEN ({a[0]}) LIKE '"%"' THEN coalesce(get_json_object(concat('{{"v":', {a[0]}, '}}'), '$.v'), {a[0]}) ELSE {a[0]} END""",
    "ATAN": lambda a: number_or_null("atan" if len(a) == 1 else "atan2")(a),
    "STD": same("stddev_pop"),
    "STDDEV": same("stddev_pop"),
    "VARIANCE": same("var_pop"),
    "FIELD": lambda a: f"coalesce(array_position(array({', '.join(a[1:])}), {a[0]}), 0)",
    "STRCMP": lambda a: f"CASE WHEN {a[0]} = {a[1]} THEN 0 WHEN {a[0]} < {a[1]} THEN -1 WHEN {a[0]} > {a[1]} THEN 1 END",
    "FORMAT": same("format_number"),
    "RAND": same("rand"),
    "SPACE": same("space"),
}


def call(name: str, args: list[str]) -> str:
    template = FUNCTIONS.get(name.upper())
    return template(args) if template else f"{name.lower()}({', '.join(args)})"
