"""Part of leafmill."""
