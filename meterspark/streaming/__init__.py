"""Messages between gathering and harmonizing, and the streaming job that consumes them."""
