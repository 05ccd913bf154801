"""End-to-end plans: raw to warehouse, warehouse to answers, answers to reports."""
