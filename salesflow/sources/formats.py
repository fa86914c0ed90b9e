"""How texts and times are written, so that what one side writes the other reads back exactly."""

from __future__ import annotations

#: Quotes inside quotes are doubled; blanks at the ends of a text belong to it.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

#: Times with all their digits.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}

CORRUPT = "_corrupt_record"
