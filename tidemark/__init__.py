"""Spark jobs over large catalogues of versioned, dated data files.

Every operator takes DataFrames and returns a DataFrame.  Nothing in the
package keeps state of its own; a catalogue is the set of DataFrames in
:class:`tidemark.model.Catalogue`.
"""

from tidemark.model import Catalogue

__all__ = ["Catalogue"]
