"""Whole reports: the BI questions, the daily market job and the query registry."""
