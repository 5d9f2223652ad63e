"""Table, log and stream operators written as plain DataFrame functions."""
