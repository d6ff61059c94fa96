"""Column functions: text, OCR decisions, citations, spans, validation, guard and metrics."""
