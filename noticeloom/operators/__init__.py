"""DataFrame operators: extraction, dedup, crawl checks, diffs, folding, signals, reports."""
