from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.schemas import SALES_LINE, ddl


def line_of_piece(piece: Column) -> Column:
    """What stands between two LF without the CR of a CRLF, or of a CR that ends the message."""
    return F.when(F.endswith(piece, F.lit("\r")), F.left(piece, F.length(piece) - 1)).otherwise(piece)


def is_line(piece: Column) -> Column:
    return F.trim(line_of_piece(piece)) != ""


def message_pieces(value: Column) -> Column:
    """One message, binary or text, cut at LF. A single character is cut without a regular expression,
    which would take several times as long as the parse of the lines."""
    return F.split(value.cast("string"), "\n")


def message_lines(value: Column, keep_blank: bool = False) -> Column:
    """Lines of one message as an array; binary or text, LF or CRLF.

    Blank lines are dropped as a CSV file scan does. With keep_blank, the message is cut at LF
    only and every piece stays, so a trailing LF gives one line without any field.
    """
    pieces = message_pieces(value)
    return pieces if keep_blank else F.transform(F.filter(pieces, is_line), line_of_piece)


def sales_fields(line: Column) -> Column:
    """One CSV line as a struct: bad fields are NULL, short lines padded, extra fields dropped."""
    return F.from_csv(line, ddl(SALES_LINE), {"mode": "PERMISSIVE"})
