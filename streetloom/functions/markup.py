"""An HTML parser that reads on where the one of the standard library stops."""

from __future__ import annotations

from html.parser import HTMLParser


class TolerantParser(HTMLParser):
    """Never fails on odd declarations; takes comments as browsers do."""

    def parse_comment(self, i, report=1):
        # ``<!-->`` is a whole comment, and one that is never closed takes the rest
        end = self.rawdata.find("-->", i + 2)
        return len(self.rawdata) if end < 0 else end + 3

    def parse_marked_section(self, i, report=1):
        # sections of any name are skipped as comments are; the parser accepts few names only
        return self.parse_bogus_comment(i)
