"""The transform language: text to a syntax tree, and the tree to Spark columns with the language's own semantics."""

from deltaloom.exprs.compiler import Compiler, compile_filter, compile_projection
from deltaloom.exprs.grammar import ParseError, parse_expression, parse_projection

__all__ = ["Compiler", "ParseError", "compile_filter", "compile_projection", "parse_expression", "parse_projection"]
