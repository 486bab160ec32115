"""Pipeline stages as pure DataFrame transforms."""
