"""Bronze, silver, gold models, reports and validation as DataFrame functions."""
