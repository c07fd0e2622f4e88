"""One pipeline per analytics question; ``registry.QUERIES`` lists them."""
