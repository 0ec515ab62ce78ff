"""The line list, the programme report and the rules they are made of."""
