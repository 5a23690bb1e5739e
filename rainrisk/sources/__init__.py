"""Sources and sinks: raw daily tables, landed pages, the feed, gazetteer, plans."""
