"""Reading the text of PDF files: objects, fonts, and the text that pages show where they show it."""
