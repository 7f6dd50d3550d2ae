"""Reading raw deliveries (files, lines, records) and prepared or star tables."""
