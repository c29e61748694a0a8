"""Surveys of public announcements as Spark jobs: pages in, report tables out."""
