"""Operators for large text corpora; nothing else in the package imports them.

Every operator takes a DataFrame, names its id and text columns, and returns a DataFrame. Rules that
hold for all of them:

* NULL text counts as empty text; a NULL id is an id like any other. Empty tables give empty results.
* Rows may repeat. Two rows with the same id but different texts are two documents; rows equal in
  both give the same result row each.
* Only the id and the text column are read, so other columns can have any name. Operators that hand
  on the input's columns say so.
* A text is always read whole, however long.
"""
