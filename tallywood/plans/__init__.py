"""Complete analyses, one function per question."""
