"""Topics and people in a follow network, derived from public activity events."""
