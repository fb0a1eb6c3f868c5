"""Lexer and precedence parser of projections and filters.

A tree is nested tuples: a kind and its parts. Keywords and function names are case-insensitive, columns are not."""

from __future__ import annotations

import re
from collections.abc import Callable


class ParseError(ValueError):
    """An expression that the language doesn't have."""


TOKEN = re.compile(
    r"""\s+|--[^\n]*
    |(?P<number>\d+\.\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|\d+(?:[eE][+-]?\d+)?)
    |(?P<string>'(?:[^']|'')*')
    |(?P<quoted>`(?:[^`]|``)*`|"(?:[^"]|"")*")
    |(?P<name>[^\W\d]\w*)
    |(?P<op><>|!=|<=|>=|\|\||[-+*/%=<>(),.\[\]])""",
    re.X,
)
COMPARISONS = {"=", "<>", "!=", "<", "<=", ">", ">="}
UNITS = {"YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND", "DOW", "DOY", "ISODOW", "ISOYEAR", "EPOCH", "CENTURY", "DECADE", "MILLENNIUM"}
#: Words that call a function without parentheses.
BARE_CALLS = {"CURRENT_DATE", "CURRENT_TIME", "CURRENT_TIMESTAMP", "LOCALTIME", "LOCALTIMESTAMP"}
RESERVED = {"AND", "OR", "NOT", "IS", "IN", "BETWEEN", "LIKE", "SIMILAR", "ESCAPE", "AS", "FROM", "FOR", "THEN", "WHEN", "ELSE", "END", "PLACING", "TO"}


def tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        found = TOKEN.match(text, at)
        if not found:
            raise ParseError(f"unexpected character {text[at]!r} at {at} in {text!r}")
        at, kind = found.end(), found.lastgroup
        if kind == "string":
            out.append((kind, found[kind][1:-1].replace("''", "'")))
        elif kind == "quoted":
            mark = found[kind][0]
            out.append((kind, found[kind][1:-1].replace(mark * 2, mark)))
        elif kind:
            out.append((kind, found[kind]))
    return [*out, ("end", "")]


class Parser:
    def __init__(self, text: str) -> None:
        self.text, self.tokens, self.at = text, tokens(text), 0

    def fail(self, wanted: str) -> ParseError:
        return ParseError(f"expected {wanted}, found {self.tokens[self.at][1] or 'the end'!r} in {self.text!r}")

    def word(self, ahead: int = 0) -> str:
        kind, value = self.tokens[min(self.at + ahead, len(self.tokens) - 1)]
        return value.upper() if kind == "name" else ""

    def take(self, *words: str) -> bool:
        """Takes these keywords or operators if they all come next."""
        for i, want in enumerate(words):
            kind, value = self.tokens[min(self.at + i, len(self.tokens) - 1)]
            if not (kind == "op" and value == want or kind == "name" and value.upper() == want):
                return False
        self.at += len(words)
        return True

    def need(self, *words: str) -> None:
        if not self.take(*words):
            raise self.fail(" ".join(words))

    def end(self) -> None:
        if self.tokens[self.at][0] != "end":
            raise self.fail("the end")

    def identifier(self) -> str:
        kind, value = self.tokens[self.at]
        if kind not in ("name", "quoted"):
            raise self.fail("a name")
        self.at += 1
        return value

    # from loose to tight

    def expression(self) -> tuple:
        left = self.conjunction()
        while self.take("OR"):
            left = ("or", left, self.conjunction())
        return left

    def conjunction(self) -> tuple:
        left = self.negation()
        while self.take("AND"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("NOT") else self.predicate()

    def predicate(self) -> tuple:
        left = self.sum()
        while True:
            kind, value = self.tokens[self.at]
            if kind == "op" and value in COMPARISONS:
                self.at += 1
                left = ("compare", "<>" if value == "!=" else value, left, self.sum())
            elif self.take("IS"):
                negated = self.take("NOT")
                if self.take("DISTINCT", "FROM"):
                    left = ("distinct", left, self.sum())
                else:
                    test = self.word()
                    if test not in ("NULL", "TRUE", "FALSE", "UNKNOWN"):
                        raise self.fail("NULL, TRUE, FALSE, UNKNOWN or DISTINCT FROM")
                    self.at += 1
                    left = ("is", test, left)
                left = ("not", left) if negated else left
            else:
                negated = self.word() == "NOT" and self.word(1) in ("BETWEEN", "IN", "LIKE", "SIMILAR")
                self.at += negated
                if self.take("BETWEEN"):
                    self.take("ASYMMETRIC")
                    low = self.sum()
                    self.need("AND")
                    left = ("between", left, low, self.sum())
                elif self.take("IN"):
                    self.need("(")
                    left = ("in", left, self.items(self.expression, ")"))
                elif self.take("LIKE"):
                    left = ("like", left, self.sum(), self.sum() if self.take("ESCAPE") else None)
                elif self.take("SIMILAR", "TO"):
                    left = ("similar", left, self.sum(), self.sum() if self.take("ESCAPE") else None)
                else:
                    return left
                left = ("not", left) if negated else left

    def sum(self) -> tuple:
        left = self.product()
        while self.tokens[self.at] in (("op", "+"), ("op", "-")):
            self.at += 1
            left = ("arithmetic", self.tokens[self.at - 1][1], left, self.product())
        return left

    def product(self) -> tuple:
        left = self.unary()
        while self.tokens[self.at] in (("op", "*"), ("op", "/"), ("op", "%"), ("op", "||")):
            self.at += 1
            op = self.tokens[self.at - 1][1]
            right = self.unary()
            left = ("call", "CONCAT", [left, right]) if op == "||" else ("arithmetic", op, left, right)
        return left

    def unary(self) -> tuple:
        if self.take("-"):
            return ("negate", self.unary())
        if self.take("+"):
            return self.unary()
        left = self.primary()
        while True:
            if self.take("["):
                left = ("item", left, self.expression())
                self.need("]")
            elif self.tokens[self.at] == ("op", ".") and left[0] in ("column", "field"):
                self.at += 1
                left = ("field", left, self.identifier())
            else:
                return left

    def items(self, one: Callable, close: str) -> list:
        out = []
        if not self.take(close):
            out.append(one())
            while self.take(","):
                out.append(one())
            self.need(close)
        return out

    def primary(self) -> tuple:
        kind, value = self.tokens[self.at]
        if kind == "number":
            self.at += 1
            return ("number", value)
        if kind == "string":
            self.at += 1
            return ("string", value)
        if kind == "quoted":
            self.at += 1
            return ("column", value)
        if self.take("("):
            inside = self.expression()
            self.need(")")
            return inside
        if kind != "name":
            raise self.fail("an expression")
        word = value.upper()
        if self.tokens[self.at + 1] == ("op", "("):
            return self.call(word, value)
        if word in ("TRUE", "FALSE", "NULL", "UNKNOWN"):
            self.at += 1
            return ("literal", {"TRUE": True, "FALSE": False}.get(word))
        if word == "CASE":
            return self.case()
        if word == "INTERVAL":
            self.at += 1
            negative = self.take("-")
            kind, number = self.tokens[self.at]
            if kind not in ("string", "number"):
                raise self.fail("an interval's length")
            self.at += 1
            unit = self.unit()
            if self.take("("):
                self.at += 1
                self.need(")")
            length, unit = interval(number, unit, self.unit() if self.take("TO") else None)
            return ("interval", -length if negative else length, unit)
        if word in ("DATE", "TIMESTAMP", "TIME") and self.tokens[self.at + 1][0] == "string":
            self.at += 2
            return ("temporal", word, self.tokens[self.at - 1][1])
        if word in BARE_CALLS:
            self.at += 1
            return ("call", word, [])
        if word in RESERVED:
            raise self.fail("an expression")
        self.at += 1
        return ("column", value)

    def unit(self) -> str:
        word = self.word()
        if word.endswith("S") and word[:-1] in UNITS:
            word = word[:-1]
        if word not in UNITS:
            raise self.fail("a unit of time")
        self.at += 1
        return word

    def case(self) -> tuple:
        self.at += 1
        subject = None if self.word() == "WHEN" else self.expression()
        branches = []
        while self.take("WHEN"):
            tests = [self.expression()]
            while self.take(","):
                tests.append(self.expression())
            self.need("THEN")
            result = self.expression()
            branches += [(t, result) for t in tests]
        other = self.expression() if self.take("ELSE") else ("literal", None)
        self.need("END")
        return ("case", subject, branches, other)

    def type(self) -> tuple:
        name, args = self.identifier().upper(), []
        if name == "DOUBLE":
            self.take("PRECISION")
        if self.take("("):
            args = [int(x[1]) for x in self.items(self.primary, ")")]
        return (name, args)

    def call(self, word: str, name: str) -> tuple:
        self.at += 2
        if word in ("CAST", "TRY_CAST"):
            value = self.expression()
            self.need("AS")
            target = self.type()
            self.need(")")
            return ("cast", value, target)
        if word == "EXTRACT":
            unit = self.unit()
            self.need("FROM")
            return self.closed("EXTRACT", [("string", unit), self.expression()])
        if word in ("TIMESTAMPADD", "TIMESTAMPDIFF", "TIMESTAMP_DIFF", "TIMESTAMP_ADD") and self.word().removeprefix("SQL_TSI_").rstrip("S") in UNITS and self.tokens[self.at + 1] == ("op", ","):
            unit = self.word().removeprefix("SQL_TSI_").rstrip("S")
            self.at += 2
            return ("call", word, [("string", unit), *self.items(self.expression, ")")])
        if word == "POSITION":
            seek = self.sum()
            self.need("IN")
            args = [seek, self.expression()]
            return self.closed(word, [*args, self.expression()] if self.take("FROM") else args)
        if word == "OVERLAY":
            args = [self.expression()]
            if self.take("PLACING"):
                args.append(self.expression())
                self.need("FROM")
                args.append(self.expression())
                if self.take("FOR"):
                    args.append(self.expression())
                return self.closed(word, args)
            self.need(",")
            return ("call", word, [*args, *self.items(self.expression, ")")])
        if word in ("SUBSTRING", "SUBSTR"):
            args = [self.expression()]
            if self.take("FROM"):
                args.append(self.expression())
                if self.take("FOR"):
                    args.append(self.expression())
                return self.closed("SUBSTRING", args)
            self.need(",")
            return ("call", "SUBSTRING", [*args, *self.items(self.expression, ")")])
        if word == "TRIM":
            side = next((s for s in ("BOTH", "LEADING", "TRAILING") if self.take(s)), "BOTH")
            if self.take("FROM"):
                return self.closed(word, [self.expression(), ("string", side)])
            what = self.expression()
            if self.take("FROM"):
                return self.closed(word, [self.expression(), ("string", side), what])
            return self.closed(word, [what, ("string", side)])
        return ("call", name, self.items(self.expression, ")"))

    def closed(self, word: str, args: list) -> tuple:
        self.need(")")
        return ("call", word, args)


#: The units of a clock, largest first, in microseconds.
CLOCK = (("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000), ("SECOND", 1_000_000))


def interval(text: str, unit: str, last: str | None) -> tuple[int, str]:
    """An interval's length in one unit: its own, MONTH for years and months, MICROSECOND for days to seconds."""
    sign, body = (-1, text.strip()[1:]) if text.strip().startswith("-") else (1, text.strip())
    if last is None and re.fullmatch(r"\d+", body):
        return sign * int(body), unit
    if (unit, last) == ("YEAR", "MONTH") and (m := re.fullmatch(r"(\d+)-(\d+)", body)):
        return sign * (12 * int(m[1]) + int(m[2])), "MONTH"
    names = [n for n, _ in CLOCK]
    if unit in names and (last or unit) in names:
        parts = re.split(r"[ :]", body)
        wanted = CLOCK[names.index(unit) : names.index(last or unit) + 1]
        if len(parts) == len(wanted) and all(re.fullmatch(r"\d+(\.\d{1,9})?" if n == "SECOND" else r"\d+", p) for p, (n, _) in zip(parts, wanted, strict=True)):
            total = 0
            for p, (_, size) in zip(parts, wanted, strict=True):
                whole, _, rest = p.partition(".")
                total += int(whole) * size + int((rest + "000000")[:6])
            return sign * total, "MICROSECOND"
    raise ParseError(f"not an interval: {text!r} {unit}{' TO ' + last if last else ''}")


def parse_expression(text: str) -> tuple:
    parser = Parser(text)
    tree = parser.expression()
    parser.end()
    return tree


def parse_projection(text: str | None) -> list[tuple[tuple | None, str | None]]:
    """(tree, alias) of each item; a wildcard has neither. An empty projection is a wildcard."""
    if not text or not text.strip():
        return [(None, None)]
    parser, out = Parser(text.replace("\\*", "*")), []
    while True:
        if parser.take("*"):
            out.append((None, None))
        else:
            tree = parser.expression()
            alias = parser.identifier() if parser.take("AS") else None
            if alias is None and parser.tokens[parser.at][0] in ("name", "quoted") and parser.word() not in RESERVED:
                alias = parser.identifier()
            if alias is None and tree[0] != "column":
                raise ParseError(f"a computed column needs a name (expr AS name): {text!r}")
            out.append((tree, alias or tree[1]))
        if not parser.take(","):
            parser.end()
            return out


def referenced(tree: object) -> set[str]:
    """The columns that a tree reads."""
    if isinstance(tree, tuple) and len(tree) == 2 and tree[0] == "column":
        return {tree[1]}
    if isinstance(tree, tuple | list):
        return set().union(*map(referenced, tree)) if tree else set()
    return set()
